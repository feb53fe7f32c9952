import hashlib
import random
import re

from barlake.llm import pii

PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x // 10 + x % 10
    return total % 10 == 0


def iban_rest(code):
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97


def base_spans(text):
    """The contract's base by its own patterns."""
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == 0
                or kind == 1 and all(int(x) <= 255 for x in m[0].split("."))
                or kind == 2 and 16 <= len(digits) <= 19 and luhn(digits)
                or kind == 3 and 8 <= len(digits) <= 15
            ):
                out.append((kind, m.start(), m.end()))
    return out


def more_spans(text, base):
    """The other patterns by Python's matcher: scores, then disjoint ones."""
    found = []
    for p in pii.MORE:
        ends = [m.span() for m in re.finditer(p.regex, text or "")]
        edges = [0, *[x for s in ends for x in s], len(text or "")]
        for k, (a, b) in enumerate(ends):
            match = text[a:b]
            digits = re.sub("[^0-9]", "", match)
            valid = {
                "card": lambda: luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
                "iban": lambda: iban_rest(match.replace(" ", "")) == 1,
                "ssn": lambda: match[:3] not in ("000", "666") and match[:3] < "900"
                and match[4:6] != "00" and match[7:] != "0000",
            }[p.kind]()
            left, right = text[max(edges[2 * k], a - pii.CONTEXT) : a], text[b : min(edges[2 * k + 3], b + pii.CONTEXT)]
            near = f"{left}\n{right}"

            def has(words):
                return re.search(r"(?i)(?<![^\W_])(?:" + "|".join(words) + r")(?![^\W_])", near)

            score = min(1.0, p.score + (pii.RAISE if has(pii.WORDS[p.kind]) else 0))
            score -= pii.LOWER if has(pii.OTHER_MEANING) else 0
            kind = pii.KINDS.index(p.kind)
            if valid and score >= pii.ACCEPTED and not any(
                k2 == kind and x < b and a < y for k2, x, y in base
            ):
                found.append((a, -b, kind))
    out, reached = [], 0
    for a, minus_b, kind in sorted(found):
        if a >= reached:
            out.append((kind, a, -minus_b))
        reached = max(reached, -minus_b)
    return out


def spans_of(df):
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"], s["base"]) for s in r["pii"]]
            for r in pii.personal_spans(df).collect()}


def expected(text):
    base = base_spans(text)
    return sorted([(*s, True) for s in base] + [(*s, False) for s in more_spans(text, base)])


PIECES = [
    "call ", "phone: ", "order no ", "card ", "iban ", "ssn ", "a.b@", "x@y.z", "c.d_e@f-g.h.i", "@", ".", " ", "-", "+",
    "+1 (509) 555-6973", "(509) 555-6973", "509-555-6973", "+44 20 7946 0958", "190.137.223.204", "1.2.3.4.5.6.7.8",
    "300.1.2.3", "0001.2.3.4", "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "378282246310005",
    "3782 822463 10005", "4222222222222", "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32",
    "GB82WEST12345698765433", "078-05-1120", "000-12-3456", "12", "7", " 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "é", "😀", "\n", "version ",
]


def test_random_texts_match_brute_force(docs):
    rng = random.Random(11)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))) for i in range(600)]
    got = spans_of(docs(rows))
    for i, text in rows:
        assert got[i] == expected(text), text


def test_known_cases(docs):
    cases = {
        "+1 (826) 555-4081 190.137.223.204": [("phone", "+1 (826) 555-4081")],  # base match too long
        "7536784127813050 4845168114407329": [("card", "4845168114407329")],
        "my card 378282246310005.": [("card", "378282246310005")],
        "378282246310005": [],
        "order card 378282246310005": [],
        "IBAN DE89 3704 0044 0532 0130 00 OK": [("iban", "DE89 3704 0044 0532 0130 00")],
        "DE89 3704 0044 0532 0130 01": [],
        "ssn 078-05-1120": [("ssn", "078-05-1120")],
        "078-05-1120": [],
        "version 509-555-6973": [],
        "tel. 509-555-6973": [("phone", "509-555-6973")],
    }
    got = spans_of(docs(list(enumerate(cases))))
    for k, (text, more) in enumerate(cases.items()):
        assert [(pii.KINDS[s[0]], text[s[1] : s[2]]) for s in got[k] if not s[3]] == more, text


def test_odd_rows(docs):
    mail = "a@b.de"
    rows = [(1, None), (2, ""), (3, mail), (3, mail), (None, mail), (4, "x" * 3_000_000), (5, "1" * 3_000_000),
            (6, "a.a@" + ".a" * 500_000), (7, "+1" + "(" * 1_000_000), (8, "1.2.3.4 " * 50_000), (9, "1-" * 1_000_000)]
    got = [(r["doc_id"], len(r["pii"]), r["lang"]) for r in pii.personal_spans(docs(rows)).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 0, "en"), (2, 0, "en"), (3, 1, "en"), (3, 1, "en"), (None, 1, "en"), (4, 0, "en"), (5, 0, "en"),
         (6, 0, "en"), (7, 0, "en"), (8, 50_000, "en"), (9, 0, "en")], key=str)


def test_empty_table_and_clashing_names(spark, docs):
    assert spans_of(docs([])) == {}
    df = spark.createDataFrame([(1, "a@b.de", 7, "x")], "doc_id long, text string, pii int, row string")
    (row,) = pii.personal_spans(df).collect()
    assert row["pii"] == 7 and row["row"] == "x" and len(row["pii_"]) == 1


def test_query_on_a_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    df = pii.op11_query(spark, folder)
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        both = expected(texts[r["doc_id"]])
        def listed(spans):
            return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b, _ in spans)
        base = [s for s in both if s[3]]
        assert r["spans"] == listed(both)
        assert r["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[0] == k for s in base) for k in range(4)]
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
