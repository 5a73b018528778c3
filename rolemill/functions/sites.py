"""Whose page an address or a link is: hosts, employers' domains, and the links on a page that lead to them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolemill.functions import fixed
from rolemill.functions.text import held, name_key, trimmed, visible_text


def host_of(url) -> Column:
    """Bare lower-case host of an address or of a host, without credentials, port and www; null where there is none."""
    host = F.regexp_extract(F.lower(trimmed(url)), r"^(?:(?:[a-z][a-z0-9+.-]*:)?//)?(?:[^/?#@]*@)?(?:www\.)?([^/?#:@\s]+)", 1)
    return F.when(host.contains("."), host)


def _under(host: Column, hosts: list[str]) -> Column:
    """Whether a host is one of these or below one of them."""
    labels = F.split(host, r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    return F.arrays_overlap(tails, F.array(*[F.lit(h) for h in hosts]))


def is_board_host(host: Column) -> Column:
    return F.coalesce(_under(host, fixed.BOARD_HOSTS), F.lit(False))


def corporate_domain(url) -> Column:
    """The employer's own domain behind an address: labels such as careers peeled off; null on a board's host."""

    def peeled(host: Column) -> Column:
        labels = F.split(host, r"\.")
        floor = F.when(F.concat_ws(".", F.element_at(labels, -2), F.element_at(labels, -1)).isin(*fixed.TWO_PART_ENDINGS), 3).otherwise(2)
        # How many labels at the front are words of career hosts, as long as the floor stays.
        n = F.aggregate(labels, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, label: F.when(a["on"] & label.isin(*fixed.CAREER_LABELS) & (F.size(labels) - a["n"] > floor), F.struct((a["n"] + 1).alias("n"), F.lit(True).alias("on"))).otherwise(F.struct(a["n"].alias("n"), F.lit(False).alias("on"))), lambda a: a["n"])
        return F.array_join(F.slice(labels, n + 1, F.size(labels)), ".")

    return held(host_of(url), lambda host: F.when(host.isNotNull() & ~is_board_host(host), peeled(host)))


def _whole(href: Column, base: Column) -> Column:
    """An address from a link and the page it is on."""
    root = F.regexp_extract(base, r"(?i)^(https?://[^/?#]+)", 1)
    folder = F.regexp_extract(base, r"(?i)^(https?://[^/?#]+(?:/[^?#]*/)?)", 1)
    slash = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return F.when(href.rlike("(?i)^https?://"), href).when(href.startswith("//"), F.concat(F.lit("https:"), href)).when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(slash, href))


def _links(html: Column, base: Column) -> Column:
    """struct(url, label) of the anchors of a page that lead to other pages."""
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)(<a\b[^>]*\bhref\s*=\s*[\"'][^\"']*[\"'][^>]*>.*?</a>)"), 1)
    found = F.transform(anchors, lambda a: F.struct(F.trim(F.regexp_extract(a, r"(?is)\bhref\s*=\s*[\"']([^\"']*)[\"']", 1)).alias("href"), visible_text(a).alias("label")))
    out = F.filter(found, lambda x: (x["href"] != "") & ~x["href"].rlike("(?i)^(?:#|mailto:|tel:|javascript:|data:)"))
    return F.transform(out, lambda x: F.struct(_whole(x["href"], base).alias("url"), x["label"].alias("label")))


def careers_link(html: Column, base: Column, domain: Column) -> Column:
    """The address of the employer's own careers page among a page's links, or null.

    It has to stay on the employer's domain, and its path or host has to be about careers; the label only supports that, and
    of several the shallowest wins, then the first.
    """

    def scored(x: Column) -> Column:
        path = F.regexp_extract(x["url"], r"(?i)^https?://[^/?#]+([^?#]*)", 1)
        about, own = path.rlike(fixed.CAREERS_PATH), held(host_of(x["url"]), lambda h: (h != domain) & (corporate_domain(h) == domain))
        deep = F.greatest(F.size(F.filter(F.split(path, "/"), lambda p: p != "")) - 1, F.lit(0))
        points = F.when(about, 40).otherwise(0) + F.when(own, 40).otherwise(0) + F.when(x["label"].rlike(fixed.CAREERS_LABEL), 20).otherwise(0) - 5 * deep
        return F.struct(F.when((corporate_domain(x["url"]) == domain) & (about | own), points).alias("points"), x["url"].alias("url"))

    graded = F.transform(_links(html, base), scored)
    best = F.aggregate(graded, F.struct(F.lit(0).alias("points"), F.lit(None).cast("string").alias("url")), lambda a, x: F.when(x["points"] > a["points"], F.struct(x["points"].cast("int").alias("points"), x["url"].alias("url"))).otherwise(a))
    return best["url"]


def employer_domain(html: Column, base: Column, name) -> Column:
    """The domain that a board's page gives for its employer, or null: one whose label is, holds or is in the employer's name.

    Addresses in meta elements count more than links in the body; that some link leads elsewhere is no evidence.
    """
    meta = F.regexp_extract_all(html, F.lit(r"(?is)<(?:meta|link)\b(?=[^>]*(?:og:url|canonical))[^>]*\b(?:content|href)\s*=\s*[\"'](https?://[^\"']+)[\"']"), 1)
    links = F.transform(_links(html, base), lambda x: x["url"])
    both = F.concat(F.transform(meta, lambda u: F.struct(u.alias("u"), F.lit(25).alias("more"))), F.transform(links, lambda u: F.struct(u.alias("u"), F.lit(0).alias("more"))))

    def scored(x: Column, key: Column) -> Column:
        def points(domain: Column) -> Column:
            label = F.replace(F.split_part(domain, F.lit("."), F.lit(1)), F.lit("-"))
            near = F.when(key == "", 0).when(label == key, 100).when((label != "") & (key.contains(label) | label.contains(key)), 60).otherwise(10)
            return F.struct(F.when(domain.isNotNull() & ~_under(domain, fixed.NOISE_HOSTS), near + x["more"]).alias("points"), domain.alias("domain"))

        return held(corporate_domain(x["u"]), points)

    def best(key: Column) -> Column:
        first = F.aggregate(F.transform(both, lambda x: scored(x, key)), F.struct(F.lit(59).alias("points"), F.lit(None).cast("string").alias("domain")), lambda a, x: F.when(x["points"] > a["points"], F.struct(x["points"].cast("int").alias("points"), x["domain"].alias("domain"))).otherwise(a))
        return first["domain"]

    return held(name_key(name), best)
