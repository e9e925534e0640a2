"""Shared helpers: tables, scratch storage, size-checked joins and connected components."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space and the ASCII controls tab to carriage return.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows up to which a side of a join is broadcast; its rows are counted first.
BROADCAST_ROWS = 20_000
#: Rows from which a key can be hot, and how many keys can be.
HOT_ROWS, HOT_KEYS = 100_000, 10_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it; a temporary one only where none is named and Spark is local."""
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        named = tempfile.mkdtemp(prefix="textloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def _delete(spark: SparkSession, path: str) -> None:
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    if jvm is not None and jsc is not None:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    try:
        _delete(spark, path)
    except Exception:  # the JVM is gone: the folder's owner cleans it
        pass


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/textloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete_at_exit, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that :func:`stored` wrote, once nothing reads them any more."""
    for df in tables:
        if path := getattr(df, "_scratch", None):
            _delete(df.sparkSession, path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column(name: str) -> Column:
    """The column of that very name, dots and all."""
    quoted = name.replace("`", "``")
    return F.col(f"`{quoted}`")


def working(name: str, prefix: str = "_in_") -> str:
    """A name for a caller's column that no other working column has, without dots or quotes."""
    return prefix + name.replace("_", "__").replace(".", "_d").replace("`", "_q")


def prefixed(name: str, prefix: str = "_in_") -> Column:
    return column(name).alias(working(name, prefix))


def join_small(big: DataFrame, small: DataFrame, key: str, how: str = "inner", limit: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Joins ``small`` (one row per key) to ``big``; nulls in the key match each other. ``how``: inner, left or left_semi.

    ``small`` is broadcast only when a count shows at most ``limit`` rows. Beyond that both are dealt by key, but for
    hot keys: those of more than ``hot_rows`` rows and a ten-thousandth of ``big``, of which there are ten thousand at most,
    meet their rows of ``small`` by broadcast.
    """
    names = [c for c in small.columns if c != key]
    small = small.select(F.col(key).alias("_k"), *names)
    joined = lambda a, b: a.join(b, a[key].eqNullSafe(b["_k"]), how).drop("_k")
    if len(small.limit(limit + 1).select("_k").collect()) <= limit:
        return joined(big, F.broadcast(small))
    counts = stored(big.groupBy(F.col(key).alias("_hot")).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows))
    bound = big.count() // HOT_KEYS if not counts.isEmpty() else 0
    hot = counts.where(F.col("_n") > bound).select("_hot")
    if hot.isEmpty():
        return joined(big, small)
    split = lambda df, c, kind: df.join(F.broadcast(hot), df[c].eqNullSafe(hot["_hot"]), kind)
    few = joined(split(big, key, "left_semi"), F.broadcast(split(small, "_k", "left_semi")))
    return few.unionByName(joined(split(big, key, "left_anti"), split(small, "_k", "left_anti")))


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of the undirected graph with edges (a, b), as rows (node, root): root is the least node.

    Alternates large-star and small-star contraction (Kiveris et al., 2014): rounds grow with the logarithm
    of the graph, edges never multiply, and no adjacency list is gathered in a task: each node needs only
    its least neighbour, which is aggregated before the shuffle.
    """
    schema = edges.schema["a"].dataType
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = _signature(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")))
        large = join_small(both, first, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.where("a <> b").distinct())
        low = stored(large.groupBy("a").agg(F.min("b").alias("low")))
        small = join_small(large, low, "a").where("b <> low").select(F.greatest("b", "low").alias("a"), F.least("b", "low").alias("b"))
        last, edges = edges, stored(small.union(low.select("a", F.col("low").alias("b"))).distinct())
        discard(last, first, large, low)
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.select(F.col("node").cast(schema), F.col("root").cast(schema))
