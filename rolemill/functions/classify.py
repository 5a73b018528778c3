"""What a posting's short fields say: remote or not, rank, kind of employment, pay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rolemill.functions import fixed
from rolemill.functions.text import present, trimmed


def mentions(c: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def is_remote(title="title") -> Column:
    """True where the title says so, else null: silence is no evidence."""
    return F.when(mentions(F.lower(F.col(title)), fixed.REMOTE_TITLE_WORDS), True)


def first_match(text: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Name of the first rule whose pattern is found and whose exception is not."""
    found = [F.when(text.rlike(p) & (~text.rlike(x) if x else F.lit(True)), F.lit(name)) for name, p, x in rules]
    return F.coalesce(*found)


def seniority(title="title") -> Column:
    return first_match(F.col(title), fixed.SENIORITY)


def placement(*columns: str) -> Column:
    text = F.lower(F.concat_ws(" ", *[F.col(c) for c in columns]))
    return F.when(mentions(text, fixed.HYBRID_WORDS), "hybrid").when(mentions(text, fixed.REMOTE_WORDS), "remote").when(mentions(text, fixed.ONSITE_WORDS), "onsite")


def employment_type(*columns: str) -> Column:
    """Kind named by the longest known word in the first column that has one."""
    words = sorted(((w, kind) for kind, found in fixed.EMPLOYMENT_WORDS.items() for w in found), key=lambda x: -len(x[0]))

    def one(c: str) -> Column:
        text = F.lower(F.col(c))
        return F.coalesce(*[F.when(text.contains(w), kind) for w, kind in words])

    return F.coalesce(*[one(c) for c in columns])


_SIGN = r"(?:CA\$|US\$|NZ\$|HK\$|A\$|S\$|R\$|[$£€¥])?"
_NUMBER, _UNIT = r"(\d[\d,. ]*)", r"([KMkm]|thousand|million)?"
_RANGE = rf"{_SIGN}\s*{_NUMBER}\s*{_UNIT}\s*(?:[-–—~]|to)\s*{_SIGN}\s*{_NUMBER}\s*{_UNIT}"
_SINGLE = rf"{_SIGN}\s*(\d[\d,. ]{{2,}})\s*{_UNIT}"


def _amount(number: Column, unit: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(number, "[, ]", ""), r"\.+$", "")
    last_dot = F.regexp_replace(plain, r"\.(?=.*\.)", "")
    scale = F.when(F.lower(unit).rlike("^(k|thousand)$"), 1e3).when(F.lower(unit).rlike("^m"), 1e6).otherwise(1.0)
    return last_dot.try_cast("double") * scale


def salary_range(summary="salary_summary") -> Column:
    """struct(min, max): the first range, else the first amount as both."""
    s = trimmed(summary)
    low, high = (_amount(F.regexp_extract(s, _RANGE, g), F.regexp_extract(s, _RANGE, g + 1)) for g in (1, 3))
    one = _amount(F.regexp_extract(s, _SINGLE, 1), F.regexp_extract(s, _SINGLE, 2))
    ranged = s.rlike(_RANGE)
    both = F.when(low > high, F.struct(high.alias("min"), low.alias("max"))).otherwise(F.struct(low.alias("min"), high.alias("max")))
    return F.when(ranged, both).when(s.rlike(_SINGLE), F.struct(one.alias("min"), one.alias("max"))).otherwise(F.struct(F.lit(None).cast("double").alias("min"), F.lit(None).cast("double").alias("max")))


def pay_period(text: Column) -> Column:
    return F.coalesce(*[F.when(text.rlike(p), period) for period, p in fixed.PERIOD_WORDS.items()])


def _as_sql(pattern: str) -> str:
    r"""The pattern read as the SQL engine does: \s without the vertical tab, and letters of either case in all scripts."""
    return pattern.replace(r"\s", fixed.SQL_BLANK).replace("(?i)", "(?iu)")


def pay_disclosed(salary_min: Column, summary: Column, description: Column) -> Column:
    said = description.rlike(_as_sql(fixed.PAY_RANGE)) | description.rlike(_as_sql(fixed.PAY_PHRASE))
    return present(salary_min).isNotNull() | present(summary).isNotNull() | F.coalesce(said, F.lit(False))


def currency(text: Column, country: Column) -> Column:
    """An ISO code in the text, else a sign, of which the plain dollar is the country's own."""
    code = F.nullif(F.regexp_extract(F.upper(text), rf"\b({'|'.join(fixed.CURRENCY_CODES)})\b", 1), F.lit(""))
    sign = F.coalesce(*[F.when(text.contains(s), c) for s, c in fixed.CURRENCY_SIGNS])
    own = F.coalesce(*[F.when(country == c, d) for c, d in fixed.DOLLARS.items()], F.lit("USD"))
    return F.coalesce(code, sign, F.when(text.contains("$"), own))


def experience_years(text: Column) -> Column:
    """Years asked for, from the first 8000 characters: a number of years with the word experience near it; 50 at most."""
    near = r"(?i)(\d{1,2})\s*(?:\+|plus|(?:-|–|to)\s*\d{1,2})?\s*\+?\s*(?:years?|yrs?)\b[^.]{0,60}?\bexperience\b|\bexperience\b[^.]{0,60}?(\d{1,2})\s*\+?\s*(?:years?|yrs?)\b"
    cut = F.substring(text, 1, 8000)
    years = F.coalesce(F.nullif(F.regexp_extract(cut, near, 1), F.lit("")), F.nullif(F.regexp_extract(cut, near, 2), F.lit(""))).try_cast("int")
    return F.when(years <= 50, years)


#: A passage that is worth a look for pay: an amount of money, or a word for pay beside a number.
PAY_HINT = r"(?i)[$£€¥]\s?\d|\b(?:salary|pay|compensation|wage)\b[^.]{0,60}\d"


def hinted(needs: Column, description="description") -> Column:
    """The description where pay is needed and the text hints at some, else null: dear rules then look at few rows."""
    text = F.col(description) if isinstance(description, str) else description
    return F.when(needs & text.rlike(PAY_HINT), text)


def offline_answer(title="title", description="description", least: int = 120) -> Column:
    """What keywords tell, in the shape of a model's answer: a stand-in where no model can be asked."""
    whole = F.concat_ws(" ", title, description)
    return F.struct(
        (F.length(F.coalesce(F.col(description), F.lit(""))) < least).alias("insufficient_text"), seniority(title).alias("seniority"), employment_type(title, description).alias("employment_type"),
        placement(title, description).alias("placement"), experience_years(F.col(description)).alias("experience"), F.length(whole).alias("characters"),
    )
