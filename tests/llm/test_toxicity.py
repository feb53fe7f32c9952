import random
import zlib

from barlake.llm import toxicity
from barlake.llm.toxicity import Lexicon, Model, _budget


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def brute_match(entries, word):
    best = ""
    for term, stem in entries:
        if stem:
            d = min(distance(term, word[:k]) for k in range(len(word) + 1))
        else:
            d = distance(term, word)
        if d == 0 and not stem:
            return "exact"
        if d == 0:
            best = "stem"
        elif d <= _budget(term, stem):
            best = best or "fuzzy"
    return best


def test_automaton_finds_what_edit_distances_find():
    rng = random.Random(0)
    entries = [("loser", False), ("idiot", False), ("scum", False), ("pathetic", False), ("worthless", False),
               ("vequ", True), ("lostraum", True), ("disgusting", False)]
    lexicon = Lexicon(entries)
    words = []
    for term, _ in entries:
        for _ in range(150):
            w = list(term + rng.choice(["", "", "e", "ung"]))
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(w) + 1)
                kind = rng.randrange(3)
                if kind == 0:
                    w.insert(at, rng.choice("aeost1"))
                elif w and kind == 1:
                    del w[min(at, len(w) - 1)]
                elif w:
                    w[min(at, len(w) - 1)] = rng.choice("aeost0")
            words.append("".join(w))
    for word in words:
        assert lexicon.match(word) == brute_match(entries, word), word


def test_quotation_is_told_from_abuse():
    model = Model(Lexicon([("loser", False)]), [])
    abuse = model.features("you are a loser", {})
    quoted = model.features('the text has "such a loser" in it', {})
    marks = model.features("on « le loser » ici", {})
    reported = model.features("he called me a loser yesterday", {})
    open_mark = model.features('a 5" loser', {})
    assert abuse[0] > 0 and abuse[3] == 0 and open_mark[0] > 0
    for f in (quoted, marks, reported):
        assert f[0] == 0 and f[3] > 0
    assert model.features(None, {}) == model.features("", {}) == [0.0] * 6


def corpus(n=600, seed=4):
    rng = random.Random(seed)
    insults, plain = ["grobnak", "snivelung"], [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    rows, labels = [], []
    for k in range(n):
        toxic = k % 6 == 0
        w = [rng.choice(plain) for _ in range(60)]
        if toxic:
            for _ in range(3):
                term = rng.choice(insults)
                if rng.random() < 0.3:
                    term = term[:3] + rng.choice("abcdefhjkmopqrtuwxyz0123456789") + term[4:]
                w[rng.randrange(60)] = term
        rows.append((k, " ".join(w)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def scored(spark, docs, rows, labels, extra=()):
    label_table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs(rows), label_table)
    got = toxicity.with_scores(docs([*rows, *extra]), model, "score").collect()
    return model, got


def test_held_out_accuracy_and_odd_rows(spark, docs):
    rows, labels = corpus()
    odd = [(9001, None), (9002, ""), (9003, "worda " * 50_000), (9003, "worda"), (None, "wordb grobnak grobnak")]
    labels = labels + [(None, 1, 1), (3, 1, None), (7777, 1, 1)]
    model, got = scored(spark, docs, rows, labels, odd)
    assert {t for t, _ in model.lexicon.entries} == {"grobnak", "snivelung"}
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 9000 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 100
    wrong = sum((r["score"] >= toxicity.THRESHOLD) != (r["doc_id"] % 6 == 0) for r in held)
    assert wrong <= 0.02 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == len(rows) + len(odd)
    assert all(r["score"] < 0.3 for r in got if r["doc_id"] in (9001, 9002, 9003))
    assert [r["score"] >= 0.3 for r in got if r["doc_id"] is None] == [True]


def test_held_out_labels_are_not_learned_from(spark, docs):
    rows, labels = corpus(240)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    a, first = scored(spark, docs, rows, labels)
    b, second = scored(spark, docs, rows, turned)
    assert a.weights == b.weights and a.lexicon.entries == b.lexicon.entries
    assert sorted(map(str, first)) == sorted(map(str, second))


def test_copies_of_a_toxic_text_do_not_make_its_words_lexicon(spark, docs):
    rows, labels = corpus(300)
    copy = "grobnak grobnak peculiarone peculiartwo"
    rows += [(1000 + k, copy) for k in range(40)]
    labels += [(1000 + k, 1, 1) for k in range(40)]
    model, _ = scored(spark, docs, rows, labels)
    assert not any(t.startswith("pecul") for t, _ in model.lexicon.entries)


def test_no_labels_and_empty_table(spark, docs):
    rows = [(1, "a b"), (2, None)]
    _, got = scored(spark, docs, rows, [])
    assert len(got) == 2 and len({r["score"] for r in got}) == 1
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.drop_toxic(docs([]), labels).collect() == []


def test_clashing_names_survive(spark, docs):
    rows, labels = corpus(240)
    df = docs(rows).withColumnRenamed("lang", "score")
    label_table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = toxicity.drop_toxic(df, label_table)
    assert kept.columns == df.columns and {r["score"] for r in kept.collect()} == {"en"}


def windows_say(text, words, k):
    """One place by its own windows: reporting words before it, marks around it in its line."""
    if not toxicity._REPORTING.isdisjoint(words[max(0, k - toxicity.CONTEXT_WORDS) : k]):
        return True
    start, end = list(toxicity._WORD.finditer(text))[k].span()
    low, high = text.rfind("\n", 0, start) + 1, text.find("\n", end)
    before, after = text[low:start], text[end : len(text) if high < 0 else high]
    if before.count('"') % 2 and '"' in after:
        return True
    return any(before.rfind(a) > before.rfind(b) and b in after for a, b in toxicity._QUOTES)


def test_mentions_are_what_the_quotation_windows_find():
    rng = random.Random(8)
    parts = ["loser", "word", "said", "x y z v w", '"', "“", "”", "„", "«", "»", "‹", "›", "\n", "."]
    model = Model(Lexicon([("loser", False)]), [])
    for _ in range(3000):
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        words, quoted = toxicity._mentions(text)
        assert words == toxicity._WORD.findall(text)
        kinds = [model.lexicon.match(w) for w in words]
        found = [k for k, (q, kind) in enumerate(zip(quoted, kinds)) if kind and q]
        assert found == [k for k, kind in enumerate(kinds) if kind and windows_say(text, words, k)], text


def test_terms_that_clean_rows_quote_stay_in_the_lexicon(spark, docs):
    rows, labels = corpus()
    rows = [
        (k, f'{t} "such a grobnak" {t}') if k % 6 == 1 else (k, f"{t} he called them a snivelung") if k % 6 == 2 else (k, t)
        for k, t in rows
    ]
    model, got = scored(spark, docs, rows, labels)
    assert {t for t, _ in model.lexicon.entries} == {"grobnak", "snivelung"}
    wrong = sum((r["score"] >= toxicity.THRESHOLD) != (r["doc_id"] % 6 == 0) for r in got)
    assert wrong <= 0.02 * len(got)


def test_without_a_lexicon_all_documents_are_kept(spark, docs):
    rows = [(k, f"alpha beta gamma delta {k % 2}") for k in range(40)] + [(None, None)]
    for labels in ([], [(9000, 1, 1)], [(k, 1, 1) for k in range(40)], [(k, 1, k % 2) for k in range(8)]):
        label_table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        model = toxicity.train(docs(rows), label_table)
        assert model.lexicon.entries == []
        assert toxicity.drop_toxic(docs(rows), label_table).count() == len(rows)


def test_long_line_with_many_matches_scores_in_linear_time():
    import time

    model = toxicity.Model(toxicity.Lexicon([("scum", False), ("vermin", False)]), [0.1] * 7)
    took = []
    for n in (20_000, 80_000):
        line = 'you scum and "vermin" they said ' * n
        begun = time.perf_counter()
        features = model.features(line, {})
        took.append(time.perf_counter() - begun)
        assert features[3] > 0 and features[4] == 1.0
    assert took[1] < 10 * took[0]
