import hashlib
import random
import zlib

import pytest

from barlake.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    return h("".join(field(v) for v in row))


def climb(leaves, arity):
    """Root of a list of digests, and every leaf's entries (before, after) up to it."""
    paths, at = [[] for _ in leaves], list(range(len(leaves)))
    while len(leaves) > 1:
        for k, i in enumerate(at):
            first = i - i % arity
            paths[k].append(("".join(leaves[first:i]), "".join(leaves[i + 1 : first + arity])))
        leaves = [h("".join(leaves[i : i + arity])) for i in range(0, len(leaves), arity)]
        at = [i // arity for i in at]
    return leaves[0], paths


def brute(rows, arity=2):
    """Rows (doc_id, source, lang, n_chars, text) to the contract's columns."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, low, ordered = [], [], []
    for name in names:
        group = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        root, paths = climb([leaf_of(r) for r in group], arity)
        subroots.append(root)
        low.append(paths)
        ordered.append(group)
    root, high = climb(subroots, arity) if subroots else (None, [])
    out = []
    for group, paths, up, subroot in zip(ordered, low, high, subroots):
        for row, path in zip(group, paths):
            seen = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                seen = (*row[:3], row[3] + 1, row[4])
            fold = leaf_of(seen)
            for before, after in path + up:
                fold = h(before + fold + after)
            proof = h("".join(b + a for b, a in path + up))
            out.append((row[0], leaf_of(row), subroot, root, proof, fold, fold == root))
    return sorted(out, key=str)


def folded_rows(df, arity):
    """The query's columns by the operator, for any arity."""
    from pyspark.sql import functions as F

    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    fields = [F.col(c) for c in merkle.FIELDS]
    changed = [c + 1 if n == "n_chars" else c for n, c in zip(merkle.FIELDS, fields)]
    rows = df.select(
        "doc_id", "lang", merkle.leaf_hash(*fields).alias("leaf"),
        F.when(tampered, merkle.leaf_hash(*changed)).alias("seen"),
    )
    found = merkle.manifest(rows, "lang", "doc_id", "leaf", arity)
    def text(c):
        return F.lower(F.hex(c))
    found = found.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot"), text("root").alias("root"),
        merkle.proof(F.col("path")),
        merkle.folded(text(F.coalesce("seen", "leaf")), F.col("path")).alias("fold"),
    )
    return sorted([(*r, r["fold"] == r["root"]) for r in found.collect()], key=str)


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def random_rows(n, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, rng.randint(0, n)]) if rng.random() < 0.1 else k,
         rng.choice(["s", None, "a:b"]), rng.choice(["en", "en", "de", None, "fr", "é"]),
         rng.choice([None, 5, 1000]), rng.choice(["", None, "ü" * 9, f"text {k}"]))
        for k in range(n)
    ]
    return rows + rows[:7]


@pytest.mark.parametrize("arity", [2, 5])
def test_manifest_matches_brute_force(spark, arity):
    rows = random_rows(23, arity)
    assert folded_rows(spark.createDataFrame(rows, DOCS), arity) == brute(rows, arity)


def test_query_on_a_table(spark, tmp_path):
    rows = random_rows(150, 9)
    extra = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS tree", "2 AS idx", "3 AS hash")
    extra.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, merkle.op13_query(spark, str(tmp_path)).collect()), key=str)
    assert got == brute(rows)


def test_one_row_one_group_and_no_rows(spark):
    one = [(5, "s", "en", 3, "abc" * 100_000)]
    assert folded_rows(spark.createDataFrame(one, DOCS), 2) == brute(one)
    (row,) = folded_rows(spark.createDataFrame(one, DOCS), 2)
    assert row[1] == row[2] == row[3] and row[4] == h("")
    equal = [(1, "s", "en", 3, "same")] * 9
    assert folded_rows(spark.createDataFrame(equal, DOCS), 2) == brute(equal)
    assert folded_rows(spark.createDataFrame([], DOCS), 2) == []


def test_tampering_is_seen_and_nothing_else(spark):
    rows = [(k, "s", "en", k, "t") for k in range(40)]
    got = folded_rows(spark.createDataFrame(rows, DOCS), 2)
    assert {r[0] for r in got if not r[-1]} == {k for k in range(40) if zlib.crc32(str(k).encode()) % 7 == 0}


def test_oracle(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = sorted(map(tuple, merkle.op13_query(spark, folder).collect()))
    assert got == sorted(con.sql(merkle.OP13_SQL).fetchall())
