"""Secret scans (operator 9) in DataFrame functions only: fixed patterns and a randomness test battery.

Base spans come from three patterns. The method adds spans of kind ``random``:
runs of 20 or more characters of ``[A-Za-z0-9+/=_-]`` with a letter and two of the
classes lower, upper and digit are candidates. For each, the encoding is inferred
(hex, base32, base36 of one case, base62 or base64) and its symbols, as numbers, go through three tests of being drawn uniformly and
independently: chi-squared over the alphabet, runs above and below the middle,
and serial correlation at lag one. A candidate that one of them rejects (level
``BATTERY_LEVEL``, Bonferroni over the three) is not random.

For the others an e-value compares the changes of character class with those of
written words, in which a class (lower, upper, digit) is kept with probability
``STAY``, and a capital is followed by a capital or a small letter alike. It is a product over the characters, so the evidence grows with the
length. The candidates of a text are chosen by the e-BH rule, which holds the
false discovery rate at ``FDR`` under any dependence.

Positions are code points. Nothing is shuffled; texts that match no pattern pay
one regular-expression scan for each pattern. Defined results: null is an empty
text; overlapping kinds are all listed, but for random spans that overlap a base
span; repeated rows each get their own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kind, pattern, group whose length counts, least length. Fixed values.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)
CANDIDATE = r"(?<![A-Za-z0-9+/=_-])(?=[0-9+/=_-]*[A-Za-z])(?=[a-z+/=_-]*[A-Z0-9])(?=[A-Z+/=_-]*[a-z0-9])[A-Za-z0-9+/=_-]{20,}"
BATTERY_LEVEL = 0.001
FDR = 0.001
STAY = 0.9
MARK = "[SECRET]"

_SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _places(text: Column, pattern: str, group: int, least: int, rank: int, kind: str) -> Column:
    """Spans of all leftmost, non-overlapping matches whose ``group`` has ``least`` characters or more.

    The texts between the matches give the positions.
    """
    p = F.lit(pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    zipped = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("all"),
        F.regexp_extract_all(text, p, F.lit(group)).alias("part"))
    empty = F.array().cast(_SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["all"])
        new = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.length(x["part"]) >= least, F.concat(acc["spans"], new)).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])
    may = text.contains("AKIA") if kind == "access" else text.rlike(pattern)
    return F.when(may, spans).otherwise(empty)


def _upper_tail(z: Column) -> Column:
    """Probability that a standard normal value is above z (logistic approximation)."""
    return 1 / (1 + F.exp(F.least(F.lit(300.0), 1.5976 * z + 0.070566 * z * z * z)))


def _characters(token: Column) -> Column:
    return F.filter(F.split(token, ""), lambda c: c != "")


def _sum(xs: Column, of) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + of(x))


def _also(xs: Column, **new) -> Column:
    """Every struct of ``xs`` with new fields, each a function of the struct so far.

    One transform for each field: a field's expression is worked out once, however often it is used.
    """
    def with_field(name: str, f):
        return lambda x: x.withField(name, f(x))

    for name, f in new.items():
        xs = F.transform(xs, with_field(name, f))
    return xs


def _battery(tokens: Column) -> Column:
    """With field ``p``: the smallest p-value of the three tests of ``codes``, times three."""
    def squares(x: Column) -> Column:  # of the symbols' counts, by their differences
        return F.aggregate(
            F.array_sort(x["codes"]), F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("sum")),
            lambda a, c: F.struct(
                c.alias("last"), F.when(a["last"] == c, a["run"] + 1).otherwise(1).alias("run"),
                (a["sum"] + F.when(a["last"] == c, 2 * a["run"] + 1).otherwise(1)).alias("sum")),
            lambda a: a["sum"])

    def runs(x: Column) -> Column:
        return F.aggregate(
            x["codes"], F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("n")),
            lambda a, c: F.struct((c >= x["k"] / 2).cast("int").alias("last"),
                                  (a["n"] + F.when(a["last"] == (c >= x["k"] / 2).cast("int"), 0.0).otherwise(1.0)).alias("n")),
            lambda a: a["n"])

    def products(x: Column) -> Column:
        return F.aggregate(
            x["codes"], F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("sum")),
            lambda a, c: F.struct((c - x["mean"]).alias("last"), (a["sum"] + F.coalesce(a["last"], F.lit(0.0)) * (c - x["mean"])).alias("sum")),
            lambda a: a["sum"])

    def smallest(x: Column) -> Column:
        n, k = x["n"], x["k"]
        chi = (k / n * x["squares"] - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        spread = F.sqrt(F.greatest((x["middle"] - 1) * (x["middle"] - 2) / (n - 1), F.lit(1e-9)))
        run = F.abs(x["runs"] - x["middle"]) / spread
        serial = F.abs(x["products"] / F.greatest(x["spread"], F.lit(1e-9)) + 1 / n) * F.sqrt(n)
        return 3 * F.least(_upper_tail(chi), 2 * _upper_tail(run), 2 * _upper_tail(serial))

    return _also(
        tokens,
        n=lambda x: F.size(x["codes"]).cast("double"),
        squares=squares, runs=runs,
        high=lambda x: _sum(x["codes"], lambda c: F.when(c >= x["k"] / 2, 1.0).otherwise(0.0)),
        middle=lambda x: 2 * x["high"] * (x["n"] - x["high"]) / x["n"] + 1,
        mean=lambda x: _sum(x["codes"], lambda c: c) / x["n"],
        spread=lambda x: _sum(x["codes"], lambda c: (c - x["mean"]) * (c - x["mean"])),
        products=products, p=smallest)


def _evidence(x: Column) -> Column:
    """Log e-value of a uniform token against a written word, by the changes of character class."""
    def kind(c: Column) -> Column:
        return F.when(c.between("0", "9"), 1).when(c.between("a", "z"), 2).when(c.between("A", "Z"), 3).otherwise(0)

    def share(k: Column) -> Column:  # of the class among the alphabet's symbols
        return F.when(k == 1, F.when(x["k"] == 32, 6.0).otherwise(10.0)).otherwise(F.when(x["k"] == 16, 6.0).otherwise(26.0)) / x["k"]

    def step(a: Column, k: Column) -> Column:
        # to and from signs a written word has no preference, so they say nothing
        others = F.when(x["k"] >= 62, 2.0).otherwise(1.0)
        written = F.when((a["last"] == 3) & (k < 4) & (k > 1), 0.45).when(a["last"] == k, STAY).otherwise((1 - STAY) / others)
        gain = F.when((k == 0) | (a["last"] <= 0), 0.0).otherwise(F.log(share(k) / written))
        return F.struct(k.alias("last"), (a["sum"] + gain).alias("sum"))

    return F.aggregate(F.transform(_characters(x["symbols"]), kind),
                       F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")), step, lambda a: a["sum"])


_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"
_HEX = "0123456789abcdef"


def _judged(text: Column, spans: Column) -> Column:
    """Candidates with the p-value of the battery and the log e-value."""
    tokens = F.transform(spans, lambda s: F.struct(s.alias("span"), F.regexp_replace(
        F.substr(text, s["start"] + 1, s["end"] - s["start"]), "=", "").alias("raw")))
    tokens = _also(
        tokens,
        k=lambda x: F.when(x["raw"].rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16.0).when(x["raw"].rlike("^[A-Z2-7]+$"), 32.0)
        .when(x["raw"].rlike("^([0-9a-z]+|[0-9A-Z]+)$"), 36.0).when(x["raw"].rlike("^[0-9A-Za-z]+$"), 62.0).otherwise(64.0),
        symbols=lambda x: F.when(x["k"].isin(16.0, 36.0), F.lower(x["raw"])).otherwise(F.translate(x["raw"], "-_", "+/")),
        alphabet=lambda x: F.when(x["k"] == 16, _HEX).when(x["k"] == 32, _BASE32).when(x["k"] == 36, _BASE36).otherwise(_BASE64),  # base62 is the first 62 of it
        codes=lambda x: F.transform(_characters(x["symbols"]), lambda c: F.instr(x["alphabet"], c) - 1))
    return F.transform(_also(_battery(tokens), e=_evidence), lambda x: F.struct(x["span"].alias("span"), x["n"].alias("n"), x["p"].alias("p"), x["e"].alias("e")))


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with struct ``_secrets``: arrays ``base`` and ``spans`` (base and random) of
    (start, rank, kind, end), by start, then kind."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    names = [F.col(f"`{c}`") for c in docs.columns]
    base = F.array_sort(F.concat(*[_places(body, p, g, n, i, k) for i, (k, p, g, n) in enumerate(BASE)]))
    found = docs.select(*names, base.alias("__base"), _places(body, CANDIDATE, 0, 20, len(BASE), "random").alias("__all"))
    free = F.filter("__all", lambda s: ~F.exists("__base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    found = found.select(*names, "__base", free.alias("__free"))
    passed = F.filter(_judged(body, F.col("__free")), lambda x: (x["n"] >= 20) & (x["p"] > BATTERY_LEVEL))
    found = found.select(*names, "__base", F.size("__free").alias("__m"), F.when(F.size("__free") > 0, passed).alias("__passed"))
    # e-BH: the most candidates k whose k-th largest e-value is m / (FDR k) or more
    order = F.reverse(F.array_sort(F.transform("__passed", lambda x: x["e"])))
    least = F.aggregate(
        F.transform(order, lambda e, i: F.when(e >= F.log(F.col("__m") / (FDR * (i + 1))), e)),
        F.lit(None).cast("double"), lambda a, e: F.coalesce(e, a))
    found = found.select(*names, "__base", "__passed", least.alias("__least"))
    chosen = F.transform(F.filter("__passed", lambda x: x["e"] >= F.col("__least")), lambda x: x["span"])
    spans = F.array_sort(F.concat("__base", F.coalesce(chosen, F.array().cast(_SPAN))))
    return found.select(*names, F.struct(F.col("__base").alias("base"), spans.alias("spans")).alias("_secrets"))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every secret span (overlapping ones as one) replaced by ``MARK``; null stays null."""
    body = F.col(f"`{text}`")

    def step(a: Column, s: Column) -> Column:
        before = F.substr(body, a["at"] + 1, s["start"] - a["at"])
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] >= a["at"], F.concat(a["out"], before, F.lit(MARK))).otherwise(a["out"]).alias("out"))

    found = find_secrets(docs, text)
    clean = F.aggregate("_secrets.spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda a: F.concat(a["out"], F.substr(body, a["at"] + 1, F.length(body) - a["at"])))
    return found.select(*[
        F.when(F.size("_secrets.spans") > 0, clean).otherwise(body).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
