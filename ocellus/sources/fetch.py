"""Distributed download of a URL manifest with an outcome per URL.

The fetch itself is I/O, so it runs in Python inside ``mapInPandas``; the
fetch function is injected (an HTTP client, or a test's own).  URLs spread
over the tasks by their hash, so a host holding a third of them spreads
too.  A crawl that is already stored needs no fetch: ``stored_outcomes``
gives the outcomes as built-in expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ocellus.functions import text as T

# A fetch function gets one row (as a dict of the input columns) and returns
# (http_status, content bytes); it may raise, which becomes outcome "error"
# ("too_large" for BodyTooLarge).
Fetcher = Callable[[dict], tuple[int, bytes | None]]

FETCH_SCHEMA = ("url string, file_name string, http_status int, outcome string, "
                "n_bytes bigint, content binary, error string")


class BodyTooLarge(Exception):
    """A body beyond the limit; it is refused, never cut."""


def stored_outcomes(pages: DataFrame, url_col: str, body_col: str,
                    allowed: Iterable[str] = T.DOWNLOAD_EXTENSIONS) -> DataFrame:
    """``outcome`` of each page of a stored crawl: a null URL or one without
    a scheme, or a body cut off before ``</html>``, is an error; an empty body
    is a 404 (``http_status``).  Row-local, no shuffle."""
    url, body = F.col(url_col), F.col(body_col)
    saved = T.extension_allowed(T.file_name(url), tuple(allowed))
    outcome: Column = (F.when(F.coalesce(F.instr(url, "://") == 0, F.lit(True)), "error")
                       .when(F.coalesce(body == "", F.lit(True)), "http_status")
                       .when(~body.rlike(r"</html>\s*$"), "error")
                       .when(saved, "saved").otherwise("bad_extension"))
    return pages.select(url_col, outcome.alias("outcome"))


def http_fetcher(timeout: float = 10.0, max_bytes: int = 50 * 1024 * 1024) -> Fetcher:
    """Plain HTTP(S) GET with the standard library, as the downloader did
    with a streaming request.  Non-200 answers return their status; bodies
    over ``max_bytes`` and network errors raise (outcome "error").  Not exercised in tests: no network."""

    def fetch(row: dict) -> tuple[int, bytes | None]:
        import urllib.error
        import urllib.request
        try:
            with urllib.request.urlopen(row["url"], timeout=timeout) as r:
                body = r.read(max_bytes + 1)
                if len(body) > max_bytes:
                    raise BodyTooLarge(f"more than {max_bytes} bytes")
                return r.status, body
        except urllib.error.HTTPError as e:
            return e.code, None

    return fetch


def _outcomes(rows: Iterator[pd.DataFrame], fetch: Fetcher, url_col: str,
              allowed: tuple[str, ...], keep_content: bool) -> Iterable[pd.DataFrame]:
    for pdf in rows:
        out = {"url": [], "file_name": [], "http_status": [], "outcome": [], "n_bytes": [],
               "content": [], "error": []}
        for rec in pdf.to_dict("records"):
            url = rec.get(url_col) or ""
            name = url.split("/")[-1]
            status, content, err = None, None, None
            try:
                status, content = fetch(rec)
                if status != 200:
                    outcome = "http_status"
                elif name.split(".")[-1].lower() in allowed:
                    outcome = "saved"
                else:
                    outcome = "bad_extension"
                    content = None
            except Exception as e:  # every failure becomes a row
                outcome = "too_large" if isinstance(e, BodyTooLarge) else "error"
                err = f"{type(e).__name__}: {e}"
                content = None
            out["url"].append(url)
            out["file_name"].append(name)
            out["http_status"].append(status)
            out["outcome"].append(outcome)
            out["n_bytes"].append(len(content) if content is not None else None)
            out["content"].append(content if keep_content else None)
            out["error"].append(err)
        res = pd.DataFrame(out)
        res["http_status"] = res["http_status"].astype("Int32")
        res["n_bytes"] = res["n_bytes"].astype("Int64")
        yield res


def fetch_urls(urls: DataFrame, fetch: Fetcher, url_col: str = "url",
               allowed: Iterable[str] = T.DOWNLOAD_EXTENSIONS,
               keep_content: bool = True, num_partitions: int | None = None) -> DataFrame:
    """One output row per input URL with ``outcome`` in {saved,
    bad_extension, http_status, too_large, error} (the reference kept no trace
    of non-200 answers; we record them).  Every column of ``urls`` is shuffled
    and handed to ``fetch``: pass those it needs."""
    allowed = tuple(a.lower() for a in allowed)
    n = num_partitions or int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return urls.repartition(n, url_col).mapInPandas(
        lambda it: _outcomes(it, fetch, url_col, allowed, keep_content), FETCH_SCHEMA)


def outcome_counts(fetched: DataFrame) -> DataFrame:
    return fetched.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
