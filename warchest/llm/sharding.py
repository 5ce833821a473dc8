"""Sharding by a Feistel permutation of global row numbers.  DataFrame functions only.

Rows get global numbers from 0 by a hash of id and text, so neither files nor partitions matter: rows that repeat id and text
are counted first, bins of about the square root of the row count are numbered by a running sum, and rows inside their bin.
A keyed Feistel network permutes the least power of two that holds all numbers; a number that lands outside walks its
cycle until it is inside.  Position p lies in shard p mod shards, slot p div shards: shard counts differ by one at most, slots have
no gaps, and `permute` or `unpermute` computes where a row lies, or which row lies somewhere, without data.

Results: a missing text has crc32 0 and no bytes.  Rows that repeat id and text are interchangeable and get a place each.
Columns `shard` and `slot` of the documents are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from warchest.llm.common import col, spool

ROUNDS = 8
#: The walk leaves the range with probability below 1/2 a step; a row that is still outside after so many raises.
WALK = 128


def _rounds(n: int, seed: int) -> tuple[int, list[tuple[int, int]]]:
    """Bits of the second half, and a key and the mask of the half that each round changes."""
    bits = max(2, (n - 1).bit_length())
    left, right = bits // 2, bits - bits // 2
    return right, [((seed << 8) + i, (1 << (right if i % 2 else left)) - 1) for i in range(ROUNDS)]


def _network(x: Column, n: int, seed: int, inverse: bool) -> Column:
    right, rounds = _rounds(n, seed)
    steps = F.array(*[F.struct(F.lit(k).cast("long").alias("key"), F.lit(m).cast("long").alias("mask")) for k, m in (rounds[::-1] if inverse else rounds)])
    mixed = lambda half, r: F.xxhash64(r["key"], half).bitwiseAND(r["mask"])

    def forth(s: Column, r: Column) -> Column:
        return F.struct(s["b"].alias("a"), s["a"].bitwiseXOR(mixed(s["b"], r)).alias("b"))

    def back(s: Column, r: Column) -> Column:
        return F.struct(s["b"].bitwiseXOR(mixed(s["a"], r)).alias("a"), s["a"].alias("b"))

    halves = F.struct(F.shiftright(x, right).alias("a"), x.bitwiseAND((1 << right) - 1).alias("b"))
    return F.aggregate(steps, halves, back if inverse else forth, lambda s: F.shiftleft(s["a"], right) + s["b"])


def _walked(x: Column, n: int, seed: int, inverse: bool) -> Column:
    if n < 2:
        return x
    tries = F.sequence(F.lit(1), F.lit(WALK))
    start = _network(x, n, seed, inverse)
    inside = F.aggregate(tries, start, lambda y, _: F.when(y < n, y).otherwise(_network(y, n, seed, inverse)))
    return F.transform(F.array(inside), lambda y: F.when(y < n, y).otherwise(F.raise_error(F.lit("the walk did not end; take another seed")).cast("long")))[0]


def permute(number: Column, n: int, seed: int = 0) -> Column:
    """Position of a row number (a long from 0 to n - 1)."""
    return _walked(number, n, seed, False)


def unpermute(position: Column, n: int, seed: int = 0) -> Column:
    return _walked(position, n, seed, True)


def _keys(df: DataFrame, text: str, doc_id: str) -> list[Column]:
    data = F.coalesce(col(text), F.lit("")).cast("binary")
    return [col(doc_id).alias("doc_id"), (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32")]


def numbered(keys: DataFrame) -> tuple[DataFrame, int]:
    """Distinct keys with `times` and `first`: the rows of a key have the global numbers first to first + times - 1."""
    names = keys.columns
    counted = spool(keys.groupBy(*names).agg(F.count(F.lit(1)).alias("times")), "keys")
    n = counted.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    bins = max(1, int(n**0.5))
    counted = counted.withColumn("hash", F.xxhash64(*names)).withColumn("bin", F.pmod("hash", F.lit(bins)))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = counted.groupBy("bin").agg(F.sum("times").alias("total"))
    totals = totals.select("bin", F.coalesce(F.sum("total").over(before.orderBy("bin")), F.lit(0)).alias("base"))
    inner = Window.partitionBy("bin").orderBy("hash", *names).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("base") + F.coalesce(F.sum("times").over(inner), F.lit(0))
    return counted.join(totals, "bin").select(*names, "times", first.alias("first")), n


def shard_rows(df: DataFrame, shards: int, *, text: str = "text", doc_id: str = "doc_id", seed: int = 0) -> DataFrame:
    """One row per row of df: doc_id, size, text_crc32, row_number, shard, slot."""
    found, n = numbered(df.select(*_keys(df, text, doc_id)))
    number = F.explode(F.sequence("first", F.col("first") + F.col("times") - 1)).alias("row_number")
    found = found.select("doc_id", "size", "text_crc32", number)
    return _placed(found, n, shards, seed).drop("position")


def _placed(df: DataFrame, n: int, shards: int, seed: int) -> DataFrame:
    df = df.withColumn("position", permute(F.col("row_number"), n, seed))
    return df.withColumns({"shard": F.pmod("position", F.lit(shards)).cast("int"), "slot": F.floor(F.col("position") / shards).cast("long")})


def shard_documents(df: DataFrame, shards: int, *, text: str = "text", doc_id: str = "doc_id", seed: int = 0) -> DataFrame:
    """The rows of df with `shard` and `slot`, which take the place of columns of these names."""
    keys = _keys(df, text, doc_id)
    found, n = numbered(df.select(*keys))
    # one text key without nulls, so that the join and the turns share one shuffle of the rows
    same = F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "size", "text_crc32").alias("same")
    rows = df.select(*keys, F.struct(*[col(c) for c in df.columns if c.lower() not in ("shard", "slot")]).alias("row")).select(same, "row")
    met = rows.join(found.select(same, "first").hint("merge"), "same")
    turn = F.row_number().over(Window.partitionBy("same").orderBy("first"))
    met = met.withColumn("row_number", F.col("first") + turn - 1)
    return _placed(met.select("row", "row_number"), n, shards, seed).select("row.*", "shard", "slot")


def write_shards(sharded: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """Parquet folders shard=0, 1, ...; each file holds a range of slots in order."""
    top = sharded.agg(F.max("slot")).first()[0] or 0
    part = F.floor(F.col("slot") * files_per_shard / (top + 1)).cast("int")
    dealt = sharded.withColumn("part", part).repartition(F.col("shard"), F.col("part"))
    dealt.sortWithinPartitions("shard", "part", "slot").drop("part").write.partitionBy("shard").parquet(path)
