"""Keys of postings: one spelling for an address, and digests that join postings across runs and providers."""

from __future__ import annotations

import re
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rolemill.functions import fixed
from rolemill.functions.text import accents_folded, digest32, squeezed, trimmed


def _kept(query: str) -> list[tuple[str, str]]:
    def tracks(name: str) -> bool:
        return name in fixed.TRACKING_PARAMETERS or name.startswith(fixed.TRACKING_PREFIX)

    return sorted((k, v) for k, v in parse_qsl(query) if not tracks(k.lower()))


def _address(url: str | None) -> str:
    bare = (url or "").strip()
    try:
        parts = urlsplit(bare)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        host = ""
    if not host:  # a path, or nothing that is an address: told apart by what it says
        return re.sub(r"\s+", "", bare)
    scheme = parts.scheme.lower() or "https"
    if port and port != {"http": 80, "https": 443}.get(scheme):
        host += f":{port}"
    path = parts.path.removesuffix("/") if len(parts.path) > 1 else parts.path
    fragment = "" if parts.fragment.lower() in fixed.PAGE_ANCHORS else parts.fragment
    return urlunsplit((scheme, host, path, urlencode(_kept(parts.query)), fragment))


@F.pandas_udf(T.StringType())
def canonical_url(urls: pd.Series) -> pd.Series:
    """One spelling for one address: scheme and host in lower case, no default port, no slash at the end, no parameters that
    track readers or are blank, the others sorted. A fragment stays unless it names a place on a page: some boards keep the
    posting's id there. Null is empty.
    """
    return urls.map(_address, na_action=None)


def job_key(url: Column) -> Column:
    return digest32(F.lit("v1|url"), canonical_url(url))


def folded(c) -> Column:
    """Lower case, without accents, single blanks."""
    return trimmed(F.regexp_replace(F.lower(trimmed(accents_folded(trimmed(c)))), r"\s+", " "))


def fallback_key(company="company", title="title", location="location") -> Column:
    """Identity that outlives a change of addresses; null without a company or a title, as a place alone merges strangers."""
    c, t = folded(company), folded(title)
    return F.when((c != "") & (t != ""), digest32(F.lit("v1|ctl"), c, t, folded(location)))


def content_hash(title="title", description="description", location="location", summary="salary_summary", commitment="commitment", employment="employment_type", truncate: int = 8000) -> Column:
    """Digest of what a posting says; blanks are collapsed before the description is cut. The employer is left out."""
    return digest32(F.lit("v1|content"), squeezed(title), F.substring(squeezed(description), 1, truncate), *[squeezed(c) for c in (location, summary, commitment, employment)])


def slugify(c) -> Column:
    return F.regexp_replace(F.regexp_replace(folded(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def run_key(company="company", ats_id="ats_id", url="url") -> Column:
    """Identity of a posting within a run: employer and id, else the address."""
    own = trimmed(ats_id)
    return F.when(own != "", F.concat_ws("\0", trimmed(company), own)).otherwise(canonical_url(F.col(url) if isinstance(url, str) else url))
