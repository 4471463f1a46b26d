"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cargoweave.sources.tables import new_path

#: White space of the contracts: the ASCII six. ``bytes.split()`` splits on the same ones.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Unicode White_Space, as the tokenizers' patterns see it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0 " + "".join(map(chr, range(0x2000, 0x200B))) + "    　"
_BEFORE_SPACE = [w + " " for w in WHITE]
_SLOW = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, so that nothing before it is computed twice, and survives the
    loss of executors, since the folder is the one that all of them share.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch: whole texts are large, and a batch is held by Spark and by Python.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """For applications of this subpackage: send whole texts to Python in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def chunks(text: str) -> list[str]:
    """Split where something that is no white space is followed by white space.

    No match of a byte-level BPE pattern reaches over such a place, so that chunks can be
    encoded, and remembered, one by one. Joined together they are the text.
    """
    if any(pair in text for pair in _BEFORE_SPACE):
        return _SLOW.findall(text)
    first, *rest = text.split(" ")
    return [*([first] if first else []), *[" " + x for x in rest]]


class Memo:
    """A bounded memory of what has been computed; what was not asked for lately is forgotten,
    which costs time and never changes a result.

    There are two generations of at most ``limit`` entries: when the young one is full it
    becomes the old one, and what is asked for again comes back from there.
    """

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        """Forget everything; tasks do so when they end, as the worker goes on to other work."""
        self.young, self.old = {}, {}

    def known(self, wanted: Iterable[str], compute) -> dict:
        """A mapping that has everything ``wanted``."""
        young, old = self.young, self.old
        if len(young) >= self.limit:
            self.old, self.young = old, young = young, {}
        missing = []
        for x in wanted:
            if x not in young:
                if x in old:
                    young[x] = old[x]
                else:
                    missing.append(x)
        young.update(zip(missing, compute(missing), strict=True))
        return young


def text_batches(texts: list[str | None], characters: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts, NULL as empty, in runs of bounded length with the first's position."""
    run: list[str] = []
    start = held = 0
    for i, text in enumerate(texts):
        run.append(text or "")
        held += len(run[-1])
        if held >= characters:
            yield start, run
            run, start, held = [], i + 1, 0
    if run:
        yield start, run


#: Ids up to which a set of them is sent to all tasks (16 MB); beyond, both sides are shuffled.
SMALL_SET = 1_000_000


def semi(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose long ``key`` is in the staged table ``wanted``, measured first."""
    few = wanted.limit(SMALL_SET + 1).count() <= SMALL_SET
    return df.join(F.broadcast(wanted) if few else wanted, key, "left_semi")
