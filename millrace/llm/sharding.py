"""Sharding by balanced label propagation, with DataFrame operations only.

Documents of equal text are linked. All start in shards dealt by hash; then, round by round until no
row moves, the shards vote for each group: its members move to the shard that can hold most of them,
counting its members there and the room left (as many shards as the group needs, if it doesn't fit
in one). Unlinked documents make way at the end, when the counts are levelled exactly. Only ids and digests move; what
reaches the driver are counts by shard.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import WRITTEN, remove, stored, table

SHARDS = 40
#: Rounds after which each must move fewer rows than the one before, so that they end.
ROUNDS = 3
#: Buckets by which moves into a shard are admitted.
BUCKETS = 256
#: What a stored file holds at least, as far as two for each core allow: every file of a local folder costs its
#: writer two processes (chmod), and a process that is just starting counts with all memory of the one that starts it.
FILE_BYTES, FILE_ROWS = 16_000_000, 50_000


def _pick(values: list[int], index: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), index)


def _mix(seed: int, *cols: str) -> Column:
    return F.xxhash64(*map(F.col, cols), F.lit(seed))


def quotas(n: int, shards: int) -> list[int]:
    """Rows of each shard: at most one apart."""
    return [n // shards + (s < n % shards) for s in range(shards)]


def files(spark: SparkSession, least: int) -> int:
    """In how many files a table is stored that fills `least` of them."""
    return max(2 * spark.sparkContext.defaultParallelism, least)


def room_left(linked: DataFrame, quota: list[int]) -> list[int]:
    have = dict(linked.groupBy("shard").count().collect())
    return [max(0, q - have.get(s, 0)) for s, q in enumerate(quota)]


def propose(linked: DataFrame, left: list[int], turn: int) -> DataFrame:
    """linked (row, grp, members, shard) with `want`: where its group's votes send each row.

    left: each shard's room. The shards that can hold most of a group are its goals, as many as it
    needs; a row outside them asks for one with room, or stays if none has any.
    """
    votes = linked.groupBy("grp", "members", "shard").count()
    held = votes.groupBy("grp", "members").agg(F.map_from_entries(F.collect_list(F.struct("shard", "count"))).alias("held"))  # an entry for each shard at most

    def judge(s: Column) -> Column:
        here, room = F.coalesce(F.try_element_at("held", s), F.lit(0)), _pick(left, s)
        return F.struct((-F.least(F.col("members"), here + room)).alias("p"), (-here).alias("c"), F.pmod(F.xxhash64("grp", s, F.lit(turn)), F.lit(1 << 20)).alias("h"), s.alias("shard"), (room > 0).alias("open"))

    def take(got: Column, x: Column) -> Column:
        enough = got["held"] >= F.col("members")
        return F.when(enough, got).otherwise(F.struct((got["held"] - x["p"]).alias("held"), F.concat(got["goals"], F.array(x["shard"])).alias("goals"), F.concat(got["open"], F.when(x["open"], F.array(x["shard"])).otherwise(F.array().cast("array<int>"))).alias("open")))

    none = F.array().cast("array<int>")
    ranked = held.withColumn("v", F.sort_array(F.transform(F.array(*map(F.lit, range(len(left)))), judge)))
    goals = ranked.select("grp", F.aggregate("v", F.struct(F.lit(0).cast("long").alias("held"), none.alias("goals"), none.alias("open")), take).alias("g"))
    open_ = F.col("g.open")
    other = F.get(open_, F.pmod(_mix(turn, "row"), F.greatest(F.size(open_), F.lit(1))).cast("int"))
    there = F.array_contains("g.goals", F.col("shard")) | (F.size(open_) == 0)
    return linked.join(goals, "grp").select("row", "grp", "members", "shard", F.array_contains("g.goals", F.col("shard")).alias("home"), F.when(there, F.col("shard")).otherwise(other).alias("want"))


def admit(wanted: DataFrame, quota: list[int], turn: int) -> tuple[DataFrame, int]:
    """Proposals are admitted bucket by bucket while the goal has room; the others stay where they are. Also the number of moves.

    A group that is small beside a shard lies in one bucket, so its rows move together.
    """
    stay = dict(wanted.where("want = shard").groupBy("shard").count().collect())
    left = [q - stay.get(s, 0) for s, q in enumerate(quota)]
    unit = F.when(F.col("members") * 8 <= quota[-1], F.xxhash64("grp", F.lit(turn + 1000))).otherwise(_mix(turn + 1000, "row"))
    at = F.pmod(unit, F.lit(BUCKETS)).cast("int")
    asked = wanted.where("want != shard").groupBy("want", at.alias("bucket")).count()  # shards x BUCKETS rows at most
    order = Window.partitionBy("want").orderBy("bucket")
    ok = asked.withColumn("upto", F.sum("count").over(order)).where(F.col("upto") <= _pick(left, F.col("want"))).groupBy("want").agg(F.max("bucket").alias("last"), F.max("upto").alias("moves")).collect()
    last = {r["want"]: r["last"] for r in ok}
    may = (F.col("want") != F.col("shard")) & (at <= _pick([last.get(s, -1) for s in range(len(quota))], F.col("want")))
    return wanted.select("row", "grp", "members", F.when(may, F.col("want")).otherwise(F.col("shard")).alias("shard"), (F.col("home") | may).alias("settled")), sum(r["moves"] for r in ok)


def level(placed: DataFrame, quota: list[int]) -> DataFrame:
    """placed (row, shard, settled, ...) with final `shard` and `slot`: counts are exactly the quotas.

    The rank in a shard is a bucket's offset plus the place in the bucket, settled rows first, so no
    window holds a whole shard. Rows beyond the quota fill the gaps of the other shards in order.
    """
    spark = placed.sparkSession
    n = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = placed.withColumn("lot", F.when(F.col("settled"), 0).otherwise(n).cast("int") + F.pmod(_mix(7, "row"), F.lit(n)).cast("int"))
    counts = placed.groupBy("shard", "lot").count()  # 2 n rows a shard
    offsets = counts.select(F.col("shard").alias("o_shard"), F.col("lot").alias("o_lot"), (F.sum("count").over(Window.partitionBy("shard").orderBy("lot")) - F.col("count")).alias("offset"))
    have = dict(counts.groupBy("shard").agg(F.sum("count")).collect())
    over, free, over_before, free_upto = [], [], [], []
    for s, q in enumerate(quota):
        h = have.get(s, 0)
        over_before.append(sum(over))
        over.append(max(0, h - q))
        free.append(max(0, q - h))
        free_upto.append(sum(free))
    ranked = placed.withColumn("_n", F.row_number().over(Window.partitionBy("shard", "lot").orderBy("row")))
    ranked = ranked.join(F.broadcast(offsets), (F.col("shard") == F.col("o_shard")) & (F.col("lot") == F.col("o_lot")))
    rank = F.col("offset") + F.col("_n") - 1
    spill = _pick(over_before, F.col("shard")) + rank - _pick(quota, F.col("shard"))
    ranked = ranked.withColumn("_rank", rank).withColumn("_spill", F.when(rank >= _pick(quota, F.col("shard")), spill))
    goal = F.size(F.filter(F.array(*(F.lit(x).cast("long") for x in free_upto)), lambda x: x <= F.col("_spill")))
    ranked = ranked.withColumn("_goal", F.when(F.col("_spill").isNotNull(), goal))
    base = _pick([have.get(s, 0) - (free_upto[s] - free[s]) for s in range(len(quota))], F.col("_goal"))
    return ranked.withColumns({"slot": F.coalesce(base + F.col("_spill"), F.col("_rank")).cast("long"), "shard": F.coalesce("_goal", "shard")})


def balanced_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of docs: id, size, text_crc32, grp (digest of the text), shard and slot.

    A null text counts as empty. Repeated rows are rows of their own; ids may be null. Equal texts
    share a shard as far as the quotas let them.
    """
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    spark = docs.sparkSession
    read = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    docs = docs.coalesce(files(spark, min(-(-read // FILE_BYTES), 1 << 30)))
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("grp")), "shard-rows")
    total = rows.count()
    quota, parts = quotas(total, shards), files(spark, -(-total // FILE_ROWS))
    sizes = rows.groupBy("grp").agg(F.count("*").alias("members")).where("members > 1")
    start = F.pmod(_mix(0, "row"), F.lit(shards)).cast("int").alias("shard")
    linked = stored(rows.select("row", "grp").join(sizes, "grp").select("row", "grp", "members", start).coalesce(parts), "shard-links")
    turn, before = 0, total
    while True:
        old = WRITTEN[-1]
        wanted = propose(linked.select("row", "grp", "members", "shard"), room_left(linked, quota), turn)
        placed, moves = admit(wanted, quota, turn)
        linked = stored(placed.coalesce(parts), f"shard-round{turn}")
        remove(spark, [old])
        turn += 1
        if not moves or (turn > rounds and moves >= before):
            break
        before = moves
    placed = rows.join(linked.select("row", F.col("shard").alias("moved"), "settled"), "row", "left")
    placed = placed.select("row", "id", "size", "text_crc32", "grp", F.coalesce("moved", start).alias("shard"), F.coalesce("settled", F.lit(False)).alias("settled"))
    return level(stored(placed.coalesce(parts), "shard-placed"), quota).select("id", "size", "text_crc32", "grp", "shard", "slot").coalesce(parts)


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = balanced_shards(table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
