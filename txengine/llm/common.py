"""Small helpers that the corpus operators share: table paths, written intermediates, the
fold of a document id, and the fixed meaning of *word*."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txengine.session import scratch_path

# A word is a maximal run of characters outside space and U+0009..U+000D. ``bytes.split``
# splits at exactly these, and ``bytes.lower`` lower-cases exactly A-Z.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut, and
    still there when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_hash(id_col: str | Column) -> Column:
    """crc32 of the id as text; a NULL id counts as empty text (0)."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def fold(id_col: str | Column, k: int) -> Column:
    """The fold 0..k-1 of a document id."""
    return F.pmod(id_hash(id_col), F.lit(k))


def lower_ascii(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def words(text: str | None) -> list[bytes]:
    """Lower-cased words of a text as UTF-8 bytes (NULL: none)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
