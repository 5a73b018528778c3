"""Names of employers and places: what boards add to them, keys to find them by, and whether they agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolemill.functions import fixed
from rolemill.functions.text import held, name_key, present, squeezed, trimmed, without_suffix

BOARD_WORDS = r"(?i)\s*(?:\b(?:corporate|external)\s+careers?\b|\b(?:careers?|jobs?|job\s+board|hiring|recruiting|talent)\b(?:\s+(?:page|site|portal))?|\(\s*(?:us|usa|united\s+states|global|corporate|hq|official)\s*\))\s*$"


def display_name(c, rounds: int = 3) -> Column:
    """A name without what boards add at its end; a name that is nothing else stays."""
    whole = squeezed(c)
    now = whole
    for _ in range(rounds):
        now = trimmed(F.regexp_replace(now, BOARD_WORDS, ""))
    return F.when(now != "", now).otherwise(whole)


def run_together(key: Column, least: int = 5) -> Column:
    """Up to two shorter forms of a key in one word that ends with legal forms, as an array; guesses beside the key."""
    ends = F.array(*[F.lit(x) for x in sorted({s.replace(" ", "") for s in fixed.LEGAL_FORMS}, key=lambda s: (-len(s), s))])

    def less(c: Column) -> Column:
        fits = F.filter(ends, lambda e: F.endswith(c, e) & (F.length(c) - F.length(e) >= least))
        return F.substring(c, F.lit(1), F.length(c) - F.length(F.get(fits, F.lit(0))))

    once = held(key, less)
    return F.array_compact(F.array(once, held(once, less)))


def first_segment(slug) -> Column:
    """The tenant of a slug "tenant/site?x"."""
    return F.regexp_extract(F.coalesce(F.col(slug) if isinstance(slug, str) else slug, F.lit("")), r"^([^/?]*)", 1)


def path_name(slug) -> Column:
    """The employer that a board's path names: its words behind the tenant that aren't words of boards or numbers."""
    behind = F.regexp_extract(F.coalesce(F.col(slug) if isinstance(slug, str) else slug, F.lit("")), r"^[^/?]*/([^?]*)", 1)
    words = F.split(F.lower(behind), "[^a-z0-9]+")
    noise = F.array(*[F.lit(w) for w in sorted(fixed.PATH_NOISE)])
    return F.array_join(F.filter(words, lambda w: (w != "") & ~F.array_contains(noise, w) & ~w.rlike("^[0-9]+$")), " ")


def declared_names(*columns: str) -> Column:
    """Core names that the columns assert, each once."""
    return F.array_distinct(F.filter(F.array(*[without_suffix(c) for c in columns]), lambda x: x != ""))


def candidate_keys(name="name", jobs_company="jobs_company", slug="slug", least: int = 4) -> Column:
    """Blocking keys of a tenant, strongest first: with and without legal forms, then shorter forms of words run together."""
    whole = lambda c: F.regexp_replace(F.lower(trimmed(c)), "[^a-z0-9]", "")
    sources = [F.col(name), F.col(jobs_company), first_segment(slug), path_name(slug)]
    found = [k for s in sources for form in (whole(s), name_key(s)) for k in (F.array(form), run_together(form))]
    stops = F.array(*[F.lit(w) for w in sorted(fixed.STOP_KEYS)])
    return F.array_distinct(F.filter(F.flatten(F.array(*found)), lambda k: (F.length(k) >= least) & ~F.array_contains(stops, k)))


def state_code(location) -> Column:
    """The two capital letters behind a comma, slash or bracket of a place."""
    return F.nullif(F.regexp_extract(F.coalesce(F.col(location) if isinstance(location, str) else location, F.lit("")), r"[,/(]\s*([A-Z]{2})\b", 1), F.lit(""))


def state_agrees(registrant: Column, tenant: Column) -> Column:
    """Whether both are in one state; unknown unless the registrant's is a state of the US and the tenant's is known."""
    known = registrant.isNotNull() & tenant.isNotNull() & registrant.isin(*fixed.STATES)
    return F.when(known, F.upper(registrant) == F.upper(tenant))


def cap_check(market_cap: Column, shares: Column, price: Column, slack: float = 0.15) -> Column:
    """Whether shares times price come near a market cap: missing, unverified, verified or disagrees."""
    apart = F.abs(shares * price - market_cap) / market_cap
    return F.when(market_cap.isNull(), "missing").when(apart.isNull(), "unverified").when(apart <= slack, "verified").otherwise("disagrees")


def band_conflict(employees: Column, low: Column, high: Column, slack: float = 3.0) -> Column:
    """Whether a head count lies outside its size band by more than slack; unknown without both."""
    return F.when(employees.isNotNull() & low.isNotNull(), (employees * slack < low) | F.coalesce(employees > high * slack, F.lit(False)))


def said_bool(c) -> Column:
    """True or false as providers write them; else unknown."""
    said = F.lower(trimmed(c))
    return F.when(said.isin("true", "t", "yes", "y", "1"), True).when(said.isin("false", "f", "no", "n", "0"), False)


def host_label(c) -> Column:
    """A slug that can be a label of a host name, else null: anything else would change the host that is asked."""
    own = trimmed(c)
    return F.when(own.rlike(r"^[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?$"), own)


def public_url(c) -> Column:
    """An http(s) address of a public host, else null: no credentials, no local names, no addresses of private networks."""
    own = trimmed(c)
    host = F.lower(F.regexp_replace(F.regexp_extract(own, r"^https?://([^/?#:]+)", 1), r"\.$", ""))
    private = r"^(?:localhost|.*\.(?:localhost|internal|local)|10\..*|127\..*|0\..*|169\.254\..*|192\.168\..*|172\.(?:1[6-9]|2[0-9]|3[01])\..*|(?:0x[0-9a-f]+|[0-9]+)(?:\.(?:0x[0-9a-f]+|[0-9]+)){0,2}|\[.*)$"
    return F.when((host != "") & host.contains(".") & ~host.contains("@") & ~host.rlike(private), own)


def place_title(c) -> Column:
    """A place written in capitals throughout, or in none, with the first letter of each word as a capital."""
    own = squeezed(c)
    return F.when((own == F.upper(own)) | (own == F.lower(own)), F.initcap(F.lower(own))).otherwise(own)


def headquarters(*places: tuple[str, str]) -> Column:
    """City and region of the first source that has a city."""
    return F.coalesce(*[F.when(present(city).isNotNull(), F.concat_ws(", ", place_title(city), present(region))) for city, region in places])


def language(title="title", description="description", least: int = 8, most: int = 400) -> Column:
    """ISO 639-1 code of a posting's language, or null where it says too little.

    A script that belongs to one language settles it. Else the language with the most of its commonest words wins, if any
    occurs; ties go by code. Only the first most characters are looked at, as the contract has it.
    """
    sample = F.substring(F.concat_ws(" ", present(title), present(description)), 1, most)
    scripts = F.coalesce(*[F.when(sample.rlike(p), code) for code, p in fixed.SCRIPTS])
    words = F.split(F.lower(sample), r"[^\p{L}']+")
    score = lambda common: F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in common])))
    scores = F.array(*[F.struct(score(common).alias("n"), F.lit(code).alias("code")) for code, common in sorted(fixed.COMMON_WORDS.items())])
    best = F.aggregate(scores, F.struct(F.lit(0).alias("n"), F.lit(None).cast("string").alias("code")), lambda a, b: F.when(b["n"] > a["n"], F.struct(b["n"].alias("n"), b["code"].alias("code"))).otherwise(a))
    return F.when(F.length(F.trim(sample)) >= least, F.coalesce(scripts, best["code"]))
