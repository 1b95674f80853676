"""Secret scan with a randomness test battery (operator 9). SQL functions only.

Keyed assignments, access keys and long hex runs are found by pattern. Other tokens that mix
letters and digits are secrets if they look drawn at random: from the characters of a token its
encoding is inferred (decimal digits aside: hex, base 32, base 36, base 64), and three tests ask
whether the characters are uniform over its alphabet (chi-squared), whether they change sides of
the alphabet's middle as often as chance would (runs), and whether neighbours are unrelated
(serial correlation). Fisher's method combines the p-values. Tokens rejected as not random at a
controlled false-discovery rate go; the control runs apart per length, since short tokens give
the tests little to see. The rest are secrets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .spans import listed, masked, matches, of_kind

# Patterns of the base, with the least length of what they find.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
ASSIGN_LEAST = 6

#: Tokens the tests look at: runs of encoding characters with a letter and a digit.
_IN = "A-Za-z0-9+/_=-"
TOKEN = rf"(?<![{_IN}])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[{_IN}]{{20,}}+"
#: Lower ends of the length bands, and the rate of tokens wrongly called not random.
BANDS, RATE = (20, 32, 48, 80), 0.05
#: p-values are counted in steps of 2^(-1/STEPS).
STEPS, MOST = 8, 512

# Encodings as regex and alphabet, the narrowest first.
ENCODINGS = [
    ("hex", "^[0-9a-f]+$|^[0-9A-F]+$", "0123456789abcdef"),
    ("base32", "^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "^[0-9a-z]+$|^[0-9A-Z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
]


def _tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, for z of either sign (a rational approximation, error below 1e-7)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = F.greatest(0.5 * poly * F.exp(-x * x), F.lit(1e-300))
    return F.when(z >= 0, half).otherwise(1 - half)


def randomness(token: Column) -> Column:
    """(n, chi, runs, serial, p) of one token: the battery's p-values and Fisher's combination."""
    alphabet = F.lit(ENCODINGS[-1][2])
    name = F.lit(ENCODINGS[-1][0])
    for label, shape, letters in reversed(ENCODINGS[:-1]):
        fits = F.rlike(token, F.lit(shape))
        alphabet, name = F.when(fits, letters).otherwise(alphabet), F.when(fits, label).otherwise(name)
    folded = F.translate(F.rtrim(token, F.lit("=")), "-_", "+/")
    # One case of hex or base 36 is read in lower case.
    read = F.when(name.isin("hex", "base36"), F.lower(folded)).otherwise(folded)

    def codes(x: Column) -> Column:
        places = F.filter(F.transform(F.split(x["read"], ""), lambda c: F.instr(x["alphabet"], c)), lambda i: i > 0)
        return F.struct(places.alias("at"), F.length(x["alphabet"]).cast("double").alias("a"))

    def counted(x: Column) -> Column:
        n = F.size(x["at"]).cast("double")
        squares = F.aggregate(F.array_distinct(x["at"]), F.lit(0.0), lambda s, c: s + F.pow(F.size(F.filter(x["at"], lambda y: y == c)).cast("double"), F.lit(2.0)))
        mean = F.aggregate(x["at"], F.lit(0.0), lambda s, y: s + y) / n
        pairs = F.arrays_zip(F.slice(x["at"], 1, F.size(x["at"]) - 1).alias("u"), F.slice(x["at"], 2, F.size(x["at"])).alias("v"))
        return F.struct(x["a"].alias("a"), n.alias("n"), x["at"].alias("at"), squares.alias("squares"), mean.alias("mean"), pairs.alias("pairs"))

    def measured(x: Column) -> Column:
        high = F.size(F.filter(x["at"], lambda y: y > x["a"] / 2)).cast("double")
        turns = F.size(F.filter(x["pairs"], lambda p: (p["u"] > x["a"] / 2) != (p["v"] > x["a"] / 2))) + F.lit(1.0)
        spread = F.aggregate(x["at"], F.lit(0.0), lambda s, y: s + F.pow(y - x["mean"], F.lit(2.0)))
        joint = F.aggregate(x["pairs"], F.lit(0.0), lambda s, p: s + (p["u"] - x["mean"]) * (p["v"] - x["mean"]))
        return F.struct(x["a"].alias("a"), x["n"].alias("n"), (x["a"] / x["n"] * x["squares"] - x["n"]).alias("x2"), high.alias("n1"), (x["n"] - high).alias("n0"), turns.alias("turns"), spread.alias("spread"), joint.alias("joint"))

    def tested(x: Column) -> Column:
        df = x["a"] - 1
        z_chi = (F.pow(F.greatest(x["x2"], F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        expect = 2 * x["n1"] * x["n0"] / x["n"] + 1
        var = (expect - 1) * (expect - 2) / (x["n"] - 1)
        z_runs = F.when(var > 0, (x["turns"] - expect) / F.sqrt(var)).otherwise(F.lit(9.0))
        z_serial = F.when(x["spread"] > 0, x["joint"] / x["spread"] * F.sqrt(x["n"])).otherwise(F.lit(9.0))
        two = lambda z: F.least(2 * _tail(F.abs(z)), F.lit(1.0))
        return F.struct(x["n"].alias("n"), _tail(z_chi).alias("chi"), two(z_runs).alias("runs"), two(z_serial).alias("serial"))

    def combined(x: Column) -> Column:
        half = -(F.log(x["chi"]) + F.log(x["runs"]) + F.log(x["serial"]))
        p = F.greatest(F.exp(-half) * (1 + half + half * half / 2), F.lit(1e-300))
        return F.struct(x["n"].cast("long").alias("n"), x["chi"].alias("chi"), x["runs"].alias("runs"), x["serial"].alias("serial"), F.least(p, F.lit(1.0)).alias("p"))

    out = F.array(F.struct(read.alias("read"), alphabet.alias("alphabet")))
    for stage in (codes, counted, measured, tested, combined):  # each stage names what the next one uses twice
        out = F.transform(out, stage)
    return F.element_at(out, 1)


def _band(length: Column) -> Column:
    band = F.lit(len(BANDS) - 1)
    for k in range(len(BANDS) - 2, -1, -1):
        band = F.when(length < BANDS[k + 1], F.lit(k)).otherwise(band)
    return band


def _bin(p: Column) -> Column:
    """Step of a p-value: larger is smaller p; the step's upper edge is 2^(-bin / STEPS)."""
    return F.least(F.floor(-F.log2(p) * STEPS), F.lit(MOST)).cast("int")


def _tokens(text: Column) -> Column:
    return F.transform(matches(text, TOKEN), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), randomness(s["value"])["p"].alias("p")))


def rejected_from(texts: DataFrame) -> list[int]:
    """Per length band the step from which tokens are rejected as not random, over all tokens.

    Benjamini and Hochberg's rule on counts per step: the least step whose upper edge is at most
    RATE times the share of tokens at or beyond it. The table has at most bands x steps rows.
    """
    tokens = texts.select(F.explode(_tokens(F.col("text"))).alias("t"))
    counts = tokens.groupBy(_band(F.col("t.end") - F.col("t.start")).alias("band"), _bin(F.col("t.p")).alias("step")).count()
    limits = [MOST + 1] * len(BANDS)
    rows = sorted(counts.collect(), key=lambda r: (r["band"], -r["step"]))
    for band in range(len(BANDS)):
        mine = [r for r in rows if r["band"] == band]
        total, beyond = sum(r["count"] for r in mine), 0
        for r in mine:
            beyond += r["count"]
            if 2 ** (-r["step"] / STEPS) <= RATE * beyond / total:
                limits[band] = r["step"]
    return limits


def _found(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` with their spans, array columns ``_base`` and ``_spans``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    limits = rejected_from(documents.select(text.alias("text")))
    kinds = [
        ("assign", F.filter(matches(text, ASSIGN, 2), lambda s: F.length(s["part"]) >= ASSIGN_LEAST)),
        ("access", matches(text, ACCESS)),
        ("hex", matches(text, HEX)),
    ]
    drawn = F.filter(_tokens(text), lambda t: _bin(t["p"]) < F.element_at(F.array(*map(F.lit, limits)), _band(t["end"] - t["start"]) + 1))
    each = documents.withColumns({f"_{name}": of_kind(spans, name, k) for k, (name, spans) in enumerate([*kinds, ("random", drawn)])})
    base = F.sort_array(F.concat("_assign", "_access", "_hex"))
    return each.withColumn("_base", base).withColumn("_spans", F.sort_array(F.concat("_base", "_random")))


def find_secrets(documents: DataFrame) -> DataFrame:
    """Per document the secrets in its whole text, as places (characters, end exclusive).

    Output: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random. A null or empty text
    has none. Repeated rows and null ids give one row each. Other columns are not read.
    """
    found = _found(documents.select("doc_id", "text"))
    size = lambda name: F.size(f"_{name}").cast("long")
    return found.select(
        "doc_id", *[size(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(listed(F.col("_base")), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans"), size("random").alias("n_random"))


def without_secrets(documents: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with each secret replaced by ``mask``; all rows and columns stay."""
    # The row travels as one column, so that no name of its own meets those of the search.
    found = _found(documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), "text"))
    text = F.when(F.size("_spans") > 0, masked(F.col("text"), F.col("_spans"), lambda _: F.lit(mask))).otherwise(F.col("text"))
    return found.select(*[text.alias(c) if c.lower() == "text" else F.col("row").getField(c).alias(c) for c in documents.columns])
