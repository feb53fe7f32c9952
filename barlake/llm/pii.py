"""Personal data: patterns propose spans, checksums confirm them, nearby words score them.

Every pattern cuts the text into the gaps between its matches (``split``) and the
matches (``regexp_extract_all``), so places are running sums of lengths; rows that a
cheap test rules out are not cut at all. A validator looks at each match where it is
found: parts of an address, Luhn, mod-97, digit counts, number ranges. A match starts
with its kind's score, which a word of its kind within ``CONTEXT`` code points on
either side raises and a word of another meaning (order, version, ...) lowers.

Two lists of patterns propose spans:

* base patterns: fixed kinds, accepted by their validator alone; context moves their
  score and never drops them
* more patterns (``MORE``): what the base patterns miss, accepted at ``ACCEPTED`` or
  more: a phone or card number that stands against other digits, so that the base
  match was dropped whole; phone numbers without ``+``; shorter cards; bank accounts
  (IBAN, mod-97); social security numbers. They count only where they touch no
  accepted base span of their kind; of those that touch each other the first stays.

All patterns are written so that a match attempt reads a run of characters once
(possessive, and no attempt inside a run that has failed), which keeps very long
texts linear; each gives the matches of its plain form.

Only numbers (lengths and scores) leave the scan, not text: candidates are stored
with their row's number, exploded, and placed by a window per row and pattern, which
is as long as one text's matches.

Defined cases: null and empty texts have no spans; rows that repeat each other get the
same result; equal starts are ordered by kind; an empty table gives an empty result;
other columns stay, whatever their names. Places are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.common import fresh, table, written

CONTEXT = 40  # code points on either side
RAISE, LOWER = 0.4, 0.3
ACCEPTED = 0.6
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")


@dataclass(frozen=True)
class Pattern:
    """A proposal: Java pattern, cheap test of the text, validator and first score."""

    kind: str
    regex: str
    valid: object  # match -> boolean Column
    score: float = 1.0
    needs: str = ""  # a text without this has no match
    base: bool = True
    words: tuple[str, ...] = field(default=(), compare=False)


# fixed values: words near a span that speak for its kind, in the languages of the corpus
WORDS = {
    "email": ("mail", "email", "e-mail", "contact", "correo", "courriel", "write to"),
    "ip": ("ip", "address", "host", "server", "adresse", "dirección"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "tax id"),
}
# fixed values: words near a number that give it another meaning
OTHER_MEANING = (
    "order", "invoice", "version", "serial", "tracking", "isbn", "part no", "ticket",
    "commande", "bestellung", "pedido", "factura", "rechnung",
)


# fixed values: length of an account code (IBAN) by country
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22,
    "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23,
    "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24,
    "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24,
    "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a Luhn sum that 10 divides."""
    from_right = F.split(F.reverse(digits), "")
    doubled = F.transform(
        from_right,
        lambda d, k: F.when(k % 2 == 0, d.try_cast("int")).otherwise(
            # the digits of twice the digit
            (d.try_cast("int") * 2) % 10 + (d >= "5").cast("int")
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, d: total + d) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code, its first four characters put last, leaves 1 modulo 97."""
    turned = F.concat(F.substring(code, 5, 40), F.substring(code, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda r, c: F.when(c.between("0", "9"), r * 10 + c.try_cast("int")).otherwise(
            r * 100 + F.ascii(c) - 55
        ) % 97,
    )
    return rest == 1


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _address_parts(match: Column) -> Column:
    """Each of the parts, leading zeros aside, is at most 255."""
    def small(part: Column) -> Column:
        value = F.regexp_replace(part, "^0+", "")
        return (F.length(value) <= 3) & (F.coalesce(value.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(match, r"\."), small)


def _card(low: int, high: int):
    # at most one mark between digits, so longer matches have too many digits
    def valid(match: Column) -> Column:
        digits = _digits(match)
        return F.when(
            F.length(match) < 2 * high, F.length(digits).between(low, high) & luhn(digits)
        ).otherwise(False)

    return valid


def _n_digits(low: int, high: int):
    return lambda match: F.length(_digits(match)).between(low, high)


def _iban(match: Column) -> Column:
    return mod97(F.regexp_replace(match, " ", ""))


def _ssn(match: Column) -> Column:
    area = F.substring(match, 1, 3)
    return (
        ~area.isin("000", "666") & (area < "900")
        & (F.substring(match, 5, 2) != "00") & (F.substring(match, 8, 4) != "0000")
    )


_LOCAL = "A-Za-z0-9._%+-"


def _iban_regex() -> str:
    """Country, two check digits and as many characters as the country's codes have, in fours."""
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    forms = []
    for length, countries in sorted(by_length.items()):
        fours, rest = divmod(length - 4, 4)
        end = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(f"(?:{'|'.join(countries)})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{fours}}}{end}")
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(forms)})(?![A-Za-z0-9])"


BASE = (
    # an attempt inside a run of local characters is needed only right behind a match
    Pattern("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
            lambda match: F.lit(True), needs="@"),
    Pattern("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _address_parts, needs="."),
    # runs with fewer digits fail the count of digits, wherever they start
    Pattern("card", r"[0-9](?:[ -]?[0-9]){15,}+", _card(16, 19)),
    Pattern("phone", r"\+[0-9][ ().0-9-]+[0-9]", _n_digits(8, 15), needs="+"),
)
MORE = (
    Pattern("card", r"(?<![0-9])[3-6][0-9]{3}(?:[ -]?[0-9]{4}){3}(?![0-9])",
            _card(16, 16), 0.6, base=False),
    Pattern("card", r"(?<![0-9])3[0-9]{3}[ -]?[0-9]{6}[ -]?[0-9]{4,5}(?![0-9])",
            _card(14, 15), 0.4, base=False),
    Pattern("card", r"(?<![0-9])4[0-9]{12}(?![0-9])", _card(13, 13), 0.3, base=False),
    Pattern("phone", r"\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{4}(?![0-9])",
            _n_digits(8, 15), 0.9, needs="+", base=False),
    Pattern("phone", r"\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2}[ .-][0-9]{4}(?![0-9])",
            _n_digits(8, 15), 0.7, needs="+", base=False),
    Pattern("phone", r"(?<![0-9+])(?<![0-9+] )\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])",
            _n_digits(10, 10), 0.6, needs="(", base=False),
    Pattern("phone", r"(?<![0-9.+-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])",
            _n_digits(10, 10), 0.4, base=False),
    Pattern("iban", _iban_regex(), _iban, 0.9, base=False),
    Pattern("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _ssn, 0.3, needs="-", base=False),
)


def any_word(words: tuple[str, ...]) -> str:
    """Pattern of any of the words, whole, in either case."""
    return r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(words) + r")(?![\p{L}\p{N}])"


_PROPOSAL = "struct<rank:int,gap:bigint,length:bigint,score:double>"


def _proposed(text: Column, pattern: Pattern, rank: int) -> Column:
    """The pattern's matches in order: gap before, length, score (null: not valid)."""
    matches = F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(0))
    gaps = F.split(text, pattern.regex, -1)  # one more than matches
    beside = F.filter(
        F.zip_with(
            F.zip_with(matches, gaps, lambda m, g: F.struct(m.alias("match"), g.alias("before"))),
            F.slice(gaps, 2, 1 << 30),
            lambda z, g: F.struct(z["match"], z["before"], g.alias("after")),
        ),
        lambda z: z["match"].isNotNull(),
    )

    def scored(z: Column) -> Column:
        near = F.concat(F.right(z["before"], F.lit(CONTEXT)), F.lit("\n"), F.left(z["after"], F.lit(CONTEXT)))
        raised = F.when(near.rlike(any_word(WORDS[pattern.kind])), RAISE).otherwise(0.0)
        lowered = F.when(near.rlike(any_word(OTHER_MEANING)), LOWER).otherwise(0.0)
        score = F.least(F.lit(1.0), F.lit(pattern.score) + raised) - lowered
        return F.struct(
            F.lit(rank).alias("rank"),
            F.length(z["before"]).cast("long").alias("gap"),
            F.length(z["match"]).cast("long").alias("length"),
            F.when(pattern.valid(z["match"]), score).alias("score"),
        ).cast(_PROPOSAL)

    present = text.rlike(pattern.regex)
    if pattern.needs:
        present = text.contains(pattern.needs) & present
    return F.when(present, F.transform(beside, scored)).otherwise(F.array().cast(f"array<{_PROPOSAL}>"))


def _accepted(found: DataFrame, row: str, proposals: str, patterns: tuple[Pattern, ...]) -> DataFrame:
    """Accepted matches of all rows: row, kind (its number), start, end, score, base."""
    each = found.select(row, F.posexplode(proposals).alias("place", "m")).select(row, "place", "m.*")
    before = Window.partitionBy(row, "rank").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    end = F.sum(F.col("gap") + F.col("length")).over(before)
    kind_of = F.array(*[F.lit(KINDS.index(p.kind)) for p in patterns])
    is_base = F.array(*[F.lit(p.base) for p in patterns])
    spans = each.withColumn("end", end).select(
        row,
        F.get(kind_of, "rank").alias("kind"),
        (F.col("end") - F.col("length")).alias("start"),
        "end",
        "score",
        F.get(is_base, "rank").alias("base"),
    )
    return spans.where(
        F.col("score").isNotNull() & (F.col("base") | (F.col("score") >= F.lit(ACCEPTED)))
    )


def _disjoint(spans: DataFrame, row: str) -> DataFrame:
    """All base spans, and the others that touch none of their kind and no earlier other."""
    of_kind = Window.partitionBy(row, "kind").orderBy("start", "end", "base")
    base_end = F.max(F.when(F.col("base"), F.col("end"))).over(
        of_kind.rowsBetween(Window.unboundedPreceding, -1)
    )
    base_start = F.min(F.when(F.col("base"), F.col("start"))).over(
        of_kind.rowsBetween(1, Window.unboundedFollowing)
    )
    free = F.coalesce(base_end <= F.col("start"), F.lit(True)) & F.coalesce(
        base_start >= F.col("end"), F.lit(True)
    )
    kept = spans.withColumn("free", free).where(F.col("base") | F.col("free"))
    others = Window.partitionBy(row, "base").orderBy("start", F.col("end").desc(), "kind")
    reached = F.max("end").over(others.rowsBetween(Window.unboundedPreceding, -1))
    return kept.withColumn("first", F.coalesce(reached <= F.col("start"), F.lit(True))).where(
        F.col("base") | F.col("first")
    )


def personal_spans(
    docs: DataFrame, text: str = "text", patterns: tuple[Pattern, ...] = BASE + MORE
) -> DataFrame:
    """The rows of ``docs`` without their texts, with their spans as ``pii``.

    An array of (kind, start, end, score, base) in that order; ``kind`` is a number in
    ``KINDS``. (The name is lengthened by ``_`` where ``docs`` has it.)
    """
    row, proposals, name, of_row = fresh(docs, "row", "proposals", "pii", "of_row")
    everything = F.concat(*[_proposed(F.col(text), p, k) for k, p in enumerate(patterns)])
    # stored with the rows' numbers, so that every later reader sees the same ones
    found = written(
        docs.select(
            *[c for c in docs.columns if c != text],
            F.monotonically_increasing_id().alias(row),
            everything.alias(proposals),
        ),
        "proposals",
    )
    spans = _disjoint(_accepted(found, row, proposals, patterns), row)
    span = F.struct("kind", "start", "end", "score", "base")
    gathered = spans.groupBy(F.col(row).alias(of_row)).agg(
        F.sort_array(F.collect_list(span)).alias("spans")
    )
    no_spans = F.array().cast(gathered.schema["spans"].dataType)
    return found.join(gathered, F.col(row) == F.col(of_row), "left").select(
        *[F.col(c) for c in docs.columns if c != text],
        F.coalesce("spans", no_spans).alias(name),
    )


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])),
        ",",
    )


def op11_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans of every document, and all its spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.filter("pii", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    return personal_spans(docs).select(
        "doc_id",
        *[count(p.kind).alias(f"n_{p.kind}") for p in BASE],
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("pii")).alias("spans"),
    )
