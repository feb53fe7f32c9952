import math
import random
from collections import defaultdict

from barlake.llm import language
from barlake.llm.common import ship_package

SYLLABLES = {"en": ["the", "ing", "th", "wh", "ed"], "de": ["ung", "sch", "keit", "ß", "ein"], "fr": ["eau", "tion", "é", "que", "oi"]}
PAGE = "page_id long, url string, html string, page string"


def words(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def corpus(spark, rows=60):
    rng = random.Random(2)
    data = [(k, words(rng, lang, 50), lang) for k, lang in enumerate(list(SYLLABLES) * (rows // 3))]
    data += [(900, None, "en"), (901, "", "de"), (902, "text", None), (None, "the", "en")]
    return spark.createDataFrame(data, "doc_id long, text string, lang string")


def pages(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(*r, "x") for r in rows], PAGE)


def html(lang, text):
    attribute = f' lang="{lang}"' if lang else ""
    return f"<html{attribute}><head><script>var t='</p>';</script></head><body><!-- c --><p>{text}</p></body></html>"


def sample_pages():
    rng = random.Random(5)
    rows = []
    for k in range(120):
        lang = rng.choice(list(SYLLABLES))
        host = rng.choice([f"a.{lang}site.com", f"{lang}.big.org", "mixed.net"])
        declared = lang if rng.random() < 0.9 else rng.choice(["en", "", "xx"])
        rows.append((k, f"https://{host}/x?y", html(declared, words(rng, lang, rng.choice([1, 2, 30])))))
    rows += [(500, None, None), (501, "not an address", ""), (7, *rows[7][1:]), (None, "http://fr.big.org", html("fr", ""))]
    return rows


def brute(model, rows):
    """The same fusion in plain Python."""
    size = len(model.languages)
    seen = []
    for page_id, url, page in rows:
        host = ""
        if url and "://" in url:
            host = url.split("://")[1].split("/")[0].lower()
        parts = host.split(".")
        declared = ""
        if page and page.startswith("<html lang="):
            declared = page.split('"')[1]
        logs = model.text(language.visible_text(page), {})
        soft = [math.exp(x) for x in logs]
        seen.append((page_id, host, ".".join(parts[-2:]), parts[-1], declared, logs, [x / sum(soft) for x in soft]))
    sums = defaultdict(lambda: [0.0] * size)
    for _, host, domain, suffix, declared, _, soft in seen:
        for key in (("h", host), ("d", domain), ("s", suffix), ("a",), ("l", declared)):
            sums[key] = [a + b for a, b in zip(sums[key], soft)]

    def smooth(n, prior):
        return [(a + language.SMOOTHING * p) / (sum(n) + language.SMOOTHING) for a, p in zip(n, prior)]

    values = {kind: sum(k[0] == kind for k in sums) for kind in "sl"}
    out = []
    for page_id, host, domain, suffix, declared, logs, soft in seen:
        prior = smooth(sums[("a",)], [1 / size] * size)
        prior = smooth(sums[("d", domain)], smooth(sums[("s", suffix)], prior))
        prior = smooth([max(a - b, 0) for a, b in zip(sums[("h", host)], soft)], prior)
        total = [x + math.log(p) for x, p in zip(logs, prior)]
        for kind, value in (("l", declared), ("s", suffix)):
            for k in range(size):
                total[k] += math.log((sums[(kind, value)][k] + 0.5) / (sums[("a",)][k] + 0.5 * values[kind]))
        raised = [math.exp(t - max(total)) for t in total]
        best = max(range(size), key=lambda k: raised[k])
        out.append((page_id, model.languages[best], round(raised[best] / sum(raised), 9), declared))
    return sorted(map(str, out))


def test_fusion_equals_brute_force(spark):
    docs, rows = corpus(spark), sample_pages()
    model = language.train(docs)
    got = language.identify(pages(spark, rows), docs).collect()
    assert sorted(str((r["page_id"], r["lang"], round(r["probability"], 9), r["declared"])) for r in got) == brute(model, rows)


def test_held_out_accuracy(spark):
    rng = random.Random(9)
    model = language.train(corpus(spark))
    right = 0
    for k in range(300):
        lang = list(SYLLABLES)[k % 3]
        logs = model.text(words(rng, lang, 12), {})
        right += model.languages[logs.index(max(logs))] == lang
    assert right >= 290


def test_other_evidence_decides_where_text_says_nothing(spark):
    rng = random.Random(1)
    rows = [(k, "http://fr.example.org/", html("fr", words(rng, "fr", 40))) for k in range(30)]
    rows += [(k, "http://de.example.org/", html("de", words(rng, "de", 40))) for k in range(30, 60)]
    rows += [(100, "http://fr.example.org/new", html("", "")), (101, "http://other.org/", html("de", "123"))]
    got = {r["page_id"]: r["lang"] for r in language.identify(pages(spark, rows), corpus(spark)).collect()}
    assert got[100] == "fr" and got[101] == "de"


def test_empty_tables(spark):
    assert language.identify(pages(spark, []), corpus(spark)).collect() == []
    nothing = corpus(spark).limit(0)
    assert language.identify(pages(spark, sample_pages()), nothing).collect() == []


def test_visible_text():
    assert language.visible_text("<p>a&amp;b</p><script>x</script><!-- c --> d").split() == ["a&b", "d"]
    assert language.visible_text(None) == ""
