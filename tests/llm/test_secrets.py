import random

from barlake.llm import secrets
from barlake.llm.common import id_held_out
from pyspark.sql import functions as F


def corpus(n=400):
    rng = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    rows = []
    for k in range(n):
        text = " ".join(rng.choice(["the", "river", "stone", "cloud", "green"]) for _ in range(30))
        kind = k % 4
        if kind == 0:
            text += " key AKIA" + "".join(rng.choices(alphabet, k=16)) + " here"
        elif kind == 1:
            text += ' token = "' + "".join(rng.choices("0123456789abcdef", k=40)) + '" end'
        elif kind == 2:
            text += " card " + "".join(rng.choices("0123456789", k=16)) + " paid"
        else:
            text += f" see river-stone-cloud-green-{rng.randint(1, 99)} page"
        rows.append((k, text))
    return rows


def scan(docs, rows):
    table = docs(rows)
    found = secrets.findings(table, secrets.dictionary(table))
    labelled = found.where(~id_held_out(F.col("doc_id"))).select("features", F.col("rule_label").alias("label"))
    return secrets.classified(found, labelled).withColumn("held_out", id_held_out(F.col("doc_id")))


def test_held_out_findings_are_told_apart(docs):
    got = scan(docs, corpus()).collect()
    assert len(got) == 400
    held = [r for r in got if r["held_out"]]
    assert len(held) > 60
    right = sum(r["predicted"] == (r["doc_id"] % 4 < 2) for r in held)
    assert right >= 0.97 * len(held)


def test_candidates_are_all_found_in_place(docs):
    value = "abc123def456ghi"
    rows = [(1, value), (2, "x " * 60_000 + value), (3, f"{value} {value}!"), (4, None), (5, ""), (6, "nodigitsatallhere"),
            (7, "short1"), (3, f"{value} {value}!"), (None, value)]
    table = docs(rows)
    got = secrets.findings(table, secrets.dictionary(table)).collect()
    places = sorted((str(r["doc_id"]), r["start"], r["length"]) for r in got)
    assert places == sorted([("1", 0, 15), ("2", 120_000, 15), ("3", 0, 15), ("3", 16, 15), ("3", 0, 15), ("3", 16, 15), ("None", 0, 15)])
    assert len({r["sha256"] for r in got}) == 1 and {r["preview"] for r in got} == {"ab...hi"}


def test_dictionary_counts_documents(docs, monkeypatch):
    monkeypatch.setattr(secrets, "FLUSH_WORDS", 2)
    rows = [(1, "stone stone river"), (2, "river"), (3, None), (4, "cloud river at")]
    assert secrets.dictionary(docs(rows), 2) == {"river": 3, "cloud": 1}


def test_features_of_coverage_and_transitions():
    own = secrets.Features({"river": 5, "stone": 3})
    assert own.coverage("riverstone") == 1 and own.coverage("xriverx") == 5 / 7 and own.coverage("q9") == 0
    plain = own.vector("riverstone12", "", "", "p")
    random_ = own.vector("x9q7z3k1v5b8", "password =", "", "p")
    assert plain[6] > random_[6] and plain[7] > random_[7] and len(plain) == len(random_) == 40


def test_labels_of_one_kind_none_and_empty(spark, docs):
    table = docs([(1, "abc123def456ghi"), (2, None)])
    found = secrets.findings(table, {})
    assert [r["predicted"] for r in secrets.classified(found, found.select("features", F.lit(1).alias("label"))).collect()] == [1]
    nothing = found.limit(0).select("features", F.lit(1).alias("label"))
    assert [r["probability"] for r in secrets.classified(found, nothing).collect()] == [0.5]
    assert scan(docs, []).collect() == []


def test_values_of_telling_names_and_runs_without_digits_are_candidates(docs):
    texts = {
        1: ("password = Tr0ub4dor&3 end", ["Tr0ub4dor&3"]),
        2: ('"secret": "my pass phrase", x', ["my pass phrase"]),
        3: ("passwd: hunter2, next", ["hunter2"]),
        4: ("see hQzKpWvRtYbN there", ["hQzKpWvRtYbN"]),
        5: ("correct-horse-battery-staple", ["correct-horse-battery-staple"]),
        6: ("api_key 'Ab.9' and token of thanks", ["Ab.9"]),
        7: ("token=nodigitsatallhere", ["nodigitsatallhere"]),
        8: ("token = abc123def456ghi&x", ["abc123def456ghi", "abc123def456ghi&x"]),
        9: ("the password is long", []),
        10: ("secret: 'left open", ["left"]),
    }
    for text, values in texts.values():
        assert [text[a:b] for a, b in secrets.candidates(text)] == values, text
    got = secrets.findings(docs([(k, text) for k, (text, _) in texts.items()]), {}).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == sorted(
        (k, len(v)) for k, (_, values) in texts.items() for v in values
    )
    assert {r["doc_id"] for r in got if r["rule_label"]} == {1, 2, 3, 7, 8, 10}


def test_no_preview_shows_a_whole_value():
    assert [secrets.preview(v) for v in ("ab", "abcde", "abcdef", "abc123def456ghi")] == ["...", "...", "a...f", "ab...hi"]
