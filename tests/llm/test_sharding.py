import math

from pyspark.sql import functions as F

from barlake.llm import sharding


def _placed(spark, tree, n=3000):
    ids = spark.range(n).select(F.col("id").alias("doc_id"))
    return {r["doc_id"]: r["s"] for r in ids.select("doc_id", sharding.shard_of(F.col("doc_id"), tree).alias("s")).collect()}


def test_draws_follow_the_tree(spark):
    """Brute force: at each level the child with the smallest -ln(u)/weight wins."""
    tree = sharding.balanced_tree(8)
    tree[5] = sharding.Leaf(tree[5].region, tree[5].rack, 5, 3.0)
    names = sorted({f"/{x.region}" for x in tree} | {f"/{x.region}/{x.rack}" for x in tree}
                   | {f"/{x.region}/{x.rack}/{x.shard}" for x in tree})
    hashes = spark.range(300).select(
        "id", *[F.xxhash64(F.col("id"), F.lit(n)).alias(f"h{k}") for k, n in enumerate(names)]
    ).collect()
    placed = _placed(spark, tree, 300)
    for row in hashes:
        def draw(name):
            h = row[f"h{names.index(name)}"] % (1 << 64)
            return ((h >> 11) + 0.5) * 2.0**-53
        def best(options):
            return min(options, key=lambda o: -math.log(draw(o[0])) / o[1])[0]
        def weight(prefix):
            return sum(x.weight for x in tree if f"/{x.region}/{x.rack}/{x.shard}/".startswith(prefix + "/"))
        node = ""
        for level in range(3):
            below = {"/".join(f"/{x.region}/{x.rack}/{x.shard}".split("/")[: level + 2]) for x in tree}
            below = sorted(b for b in below if b.startswith(node + "/"))
            node = best([(b, weight(b)) for b in below])
        assert int(node.rsplit("/", 1)[1]) == placed[row["id"]]


def test_growth_moves_rows_only_into_the_new_shard(spark):
    tree = sharding.balanced_tree(16)
    old, new = _placed(spark, tree), _placed(spark, sharding.grown(tree))
    moved = {i for i in old if old[i] != new[i]}
    assert moved and all(new[i] == 16 for i in moved)
    assert len(moved) < 2 * len(old) / 17


def test_weight_change_is_confined_to_its_subtrees(spark):
    """A heavier shard takes rows into its region; other regions' shards gain none."""
    tree = sharding.balanced_tree(8)
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, 2.0 if x.shard == 7 else 1.0) for x in tree]
    old, new = _placed(spark, tree), _placed(spark, heavier)
    region = {x.shard: x.region for x in tree}
    assert all(region[new[i]] == region[7] for i in old if old[i] != new[i])


def test_shares_follow_weights(spark):
    tree = [sharding.Leaf("a", "x", 0, 1.0), sharding.Leaf("a", "y", 1, 2.0), sharding.Leaf("b", "z", 2, 5.0)]
    placed = list(_placed(spark, tree, 8000).values())
    for leaf in tree:
        assert abs(placed.count(leaf.shard) / 8000 - leaf.weight / 8) < 0.03


def test_slots_are_gapless_with_nulls_and_repeats(spark):
    rows = [(i % 40 if i % 7 else None, i % 3) for i in range(500)] + [(1, 1)] * 200
    df = spark.createDataFrame(rows, "doc_id long, shard int")
    got = sharding.gapless_slots(df, "shard", ["doc_id"], buckets=16).collect()
    assert len(got) == len(rows)
    for shard in range(3):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(
            range(sum(r[1] == shard for r in rows))
        )


def test_slots_leave_columns_with_working_names(spark):
    df = spark.createDataFrame([(k, 0, "b", 3) for k in range(20)], "doc_id long, shard int, bucket string, rank int")
    got = sharding.gapless_slots(df, "shard", ["doc_id"], buckets=4).collect()
    assert sorted(r["slot"] for r in got) == list(range(20))
    assert {(r["bucket"], r["rank"]) for r in got} == {("b", 3)}


def test_query_on_empty_and_odd_rows(spark, tmp_path):
    rows = [(1, "a"), (1, "a"), (2, None), (3, ""), (None, "é" * 10), (None, "é" * 10)]
    for name, some in (("full", rows), ("empty", [])):
        spark.createDataFrame(some, "doc_id long, text string").write.parquet(str(tmp_path / name / "documents.parquet"))
        got = sharding.op7_query(spark, str(tmp_path / name)).collect()
        assert len(got) == len(some)
        assert {r["size"] for r in got} <= {2, 1, 21}
        per = {}
        for r in got:
            per.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in per.values())


def test_equal_rows_are_numbered_in_many_pieces(spark, monkeypatch):
    """A third of all rows are equal: no window partition holds more than a few of them."""
    tables = []
    keep = sharding.written
    monkeypatch.setattr(sharding, "written", lambda df, name: tables.append(keep(df, name)) or tables[-1])
    rows = [(k, 0) for k in range(4000)] + [(None, 0)] * 2000
    df = spark.createDataFrame(rows, "doc_id long, shard int").repartition(4)
    got = sharding.gapless_slots(df, "shard", ["doc_id"], buckets=64).collect()
    assert sorted(r["slot"] for r in got) == list(range(6000)) and set(got[0].asDict()) == {"doc_id", "shard", "slot"}
    nulls = sorted(r["slot"] for r in got if r["doc_id"] is None)
    assert nulls == list(range(nulls[0], nulls[0] + 2000))
    (stored,) = tables
    assert max(r["count"] for r in stored.groupBy("shard", "bucket", "doc_id", "salt").count().collect()) < 100


def test_shard_count_decides_the_tree(spark, docs, tmp_path):
    """With one more shard the query places every document where it said it would."""
    docs([(k, f"t{k}") for k in range(400)]).write.parquet(str(tmp_path / "documents.parquet"))
    for shards in (16, 17):
        now = {r["doc_id"]: r["grown_shard"] for r in sharding.op7_query(spark, str(tmp_path), shards).collect()}
        then = {r["doc_id"]: r["shard"] for r in sharding.op7_query(spark, str(tmp_path), shards + 1).collect()}
        assert now == then
