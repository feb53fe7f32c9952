import random

from barlake.llm import line_dedup


def brute(rows, min_words):
    """Extend every match of two lines both ways; delete the later side of runs of min_words words."""
    docs = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    lines = [
        [(k, x.strip(), len(x.split())) for k, x in enumerate(doc[1].split("\n")) if x.split()] for doc in docs
    ]
    places, gone = {}, {}
    for d, doc in enumerate(docs):
        for a in range(len(lines[d])):
            here = places.setdefault(lines[d][a][1], [])
            for e, b in here:
                if a and b and lines[d][a - 1][1] == lines[e][b - 1][1]:
                    continue  # the match began before
                n = 0
                while a + n < len(lines[d]) and b + n < len(lines[e]) and lines[d][a + n][1] == lines[e][b + n][1]:
                    n += 1
                run_lines = lines[d][a : a + n]
                if sum(x[2] for x in run_lines) >= min_words:
                    gone.setdefault(d, set()).update(x[0] for x in run_lines)
            here.append((d, a))
    for d, at in gone.items():  # blank lines between two lines that go
        for (k, *_), (m, *_) in zip(lines[d], lines[d][1:]):
            if k in at and m in at:
                at.update(range(k, m))
    gone = {docs[d]: at for d, at in gone.items()}
    out = []
    for doc in rows:
        if doc[1] is None:
            out.append((doc[0], None))
        else:
            out.append((doc[0], "\n".join(
                x for k, x in enumerate(doc[1].split("\n")) if k not in gone.get(doc, ())
            )))
    return out


def run(docs, rows, min_words):
    got = line_dedup.delete_repeated_lines(docs(rows), min_words=min_words)
    return [(r["doc_id"], r["text"]) for r in got.collect()]


def key(row):
    return (row[0] is not None, row[0] or 0, row[1] is not None, row[1] or "")


def test_random_documents_match_brute_force(docs):
    rng = random.Random(5)
    pool = [" ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(1, 6))) for _ in range(25)] + ["", "  "]
    rows = []
    for i in range(80):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 12))]
        if i % 3 == 0 and rows:
            donor = rng.choice(rows)[1].split("\n")
            lines[2:2] = donor[rng.randint(0, 3):][: rng.randint(1, 8)]
        rows.append((i, "\n".join(lines)))
    for min_words in (1, 6, 12):
        assert sorted(run(docs, rows, min_words), key=key) == sorted(brute(rows, min_words), key=key)


def test_odd_rows(docs):
    passage = "\n".join("one two three four five six" for _ in range(10))
    rows = [(1, passage), (1, passage), (2, passage + "\ntail"), (None, "x"), (3, None), (4, ""), (5, "long " * 5000)]
    got = run(docs, rows, 50)
    assert sorted(got, key=key) == sorted(brute(rows, 50), key=key)
    assert (2, "tail") in got and (3, None) in got and (4, "") in got


def test_long_passage_goes_and_short_repeats_stay(docs):
    rng = random.Random(1)
    passage = " ".join(f"p{rng.random()}" for _ in range(51))
    footer = "all rights reserved by the owner"
    rows = [(i, f"unique line number {i}\n{passage}\nown line {i}\n{footer}") for i in range(6)]
    got = dict(run(docs, rows, 50))
    assert passage in got[0]
    assert all(got[i] == f"unique line number {i}\nown line {i}\n{footer}" for i in range(1, 6))


def test_no_tail_of_a_repeated_run_stays(docs):
    lines = [" ".join(f"{mark}{k}" for k in range(n)) for mark, n in (("a", 20), ("b", 60), ("c", 20), ("d", 5))]
    rows = [(i, "\n".join([f"own {i}", *lines, f"end {i}"])) for i in range(3)]
    rows.append((3, "\n".join(lines)))  # an exact copy of the run: nothing stays
    rows.append((4, "\n".join(lines[2:])))  # 25 words repeat: too few
    got = dict(run(docs, rows, 50))
    assert got == dict(brute(rows, 50))
    assert got[1] == "own 1\nend 1" and got[3] == "" and got[4] == rows[4][1]


def test_blank_lines_between_paragraphs_of_a_copy_go(docs):
    a, b = (" ".join(f"{mark}{k}" for k in range(60)) for mark in "ab")
    rows = [(0, f"{a}\n\n \n{b}\n"), (1, f"{a}\n\n \n{b}\n"), (2, f"{b}\n\n{a}\n\nown"), (3, f"own\n\n{a}")]
    got = dict(run(docs, rows, 50))
    assert got == dict(brute(rows, 50))
    assert got[1] == "" and got[2] == "\nown" and got[3] == "own\n"


def test_tail_matches_another_place_than_the_head(docs):
    a, b, c = (" ".join(f"{mark}{k}" for k in range(n)) for mark, n in (("a", 60), ("b", 20), ("c", 20)))
    rows = [(0, f"{a}\nx"), (1, f"y\n{a}\n{b}"), (2, f"{a}\n{b}\n{c}")]
    got = dict(run(docs, rows, 50))
    assert got == dict(brute(rows, 50))
    assert got[1] == f"y\n{b}" and got[2] == c


def test_empty_table_and_clashing_names(spark, docs):
    assert run(docs, [], 50) == []
    df = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, n_lines int, _id string")
    (row,) = line_dedup.delete_repeated_lines(df).collect()
    assert row["n_lines"] == 7 and row["_id"] == "x" and row["n_lines_"] == 1


def test_plan_has_no_python(spark, docs):
    plan = line_dedup.delete_repeated_lines(docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
