"""Pages behind http(s) URLs, fetched by the executors; a URL that fails is a row, never a failed task."""

from collections.abc import Iterator
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.schema import BROKEN

#: Seconds before a server counts as silent, and what a request says of itself.
TIMEOUT = 20
AGENT = "Mozilla/5.0 (compatible; millrace)"


def _utf8(data: bytes, named: str | None) -> bytes:
    """data as UTF-8: by the encoding that it seems to have, else the one its server names, else with replacement."""
    for name in ("utf-8-sig", named, "gb18030", "big5"):
        try:
            return data.decode(name).encode() if name else data.decode("ascii").encode()
        except (UnicodeError, LookupError):
            continue
    return data.decode("utf-8", "replace").encode()


def fetched(urls: DataFrame, timeout: float = TIMEOUT) -> DataFrame:
    """urls (source) -> asked, source (the URL after redirects), content (UTF-8; null if it failed), error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch.column(0).to_pylist():
                try:
                    with urlopen(Request(url, headers={"User-Agent": AGENT}), timeout=timeout) as r:
                        got = (r.geturl(), _utf8(r.read(), r.headers.get_content_charset()), None)
                except Exception as e:  # whatever a server does stays in its row
                    got = (url, None, f"Failed to fetch {url}: {e}")
                yield pa.record_batch([pa.array([x], t) for x, t in zip((url, *got), (pa.string(), pa.string(), pa.binary(), pa.string()))], ["asked", "source", "content", "error"])

    return urls.select("source").mapInArrow(run, "asked string, source string, content binary, error string")


def split(got: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files (source, content) for plans.corpus.parse, and failure rows, of stored fetched() rows."""
    return got.where("error IS NULL").select("source", "content"), got.where("error IS NOT NULL").select(F.col("asked").alias("source"), "error", F.lit(BROKEN).alias("kind"))
