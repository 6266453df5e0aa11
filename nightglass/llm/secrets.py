"""Secret scans: three fixed patterns, and a randomness test battery over other long tokens.

A token's encoding is inferred from its characters. Three statistics compare it with uniform random draws from that alphabet: chi-squared of the
symbol counts, runs above and below the middle, and serial correlation. Tokens that look random are then tested
against the alternative that they are ordinary text, whose symbol counts are uneven: this p-value falls with length.
Benjamini-Hochberg per length class bounds the share of false discoveries among the different tokens of the whole corpus:
copies of a token are one test.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from nightglass.llm.common import write_out
from nightglass.llm.spans import SPAN, Kind, listed, with_spans

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run of hex digits, or of AKIA and what follows, that is too short has no longer one inside it; so the least
# length can stand in the pattern. The value of an assignment is checked after the match.
BASE = [
    Kind("assign", ASSIGN, lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 1)) >= 12),
    Kind("access", r"AKIA[A-Z0-9]{14,}"),
    Kind("hex", r"[0-9a-f]{16,}"),
]
TOKEN = Kind("random", r"[A-Za-z0-9+/_=-]{20,}")

HEX, BASE32, BASE62 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
UPPER_HEX, BASE64 = HEX.upper(), BASE62 + "+/"
# (alphabet, pattern of its tokens, what - and _ are read as, unevenness of ordinary text in it: size * sum of squared symbol
# shares - 1). Hex may come in parts, like a UUID; it is tested without what separates them,
# if it has LEAST_HEX digits.
ENCODINGS = [
    (HEX, r"^[0-9a-f][0-9a-f_-]*$", "", 0.6),
    (UPPER_HEX, r"^[0-9A-F][0-9A-F_-]*$", "", 0.6),
    (BASE32, r"^[A-Z2-7]+$", "+/", 1.1),
    (BASE62, r"^[A-Za-z0-9]+$", "+/", 2.6),
    (BASE64, r".", "+/", 2.8),
]
LEAST_HEX = 16
Z_LIMIT = 4.0
FALSE_SHARE = 0.05
LENGTHS = (20, 32, 48, 96)
BIN, BINS = 16, 2048


def normal_below(z: Column) -> Column:
    """Logarithm of the normal distribution function, by the usual rational bound for its tail."""
    x = F.abs(z)
    density = -x * x / 2 - F.lit(math.log(math.sqrt(2 * math.pi)))
    tail = density - F.log(0.661 * x + 0.339 * F.sqrt(x * x + 5.51))
    return F.when(z <= 0, tail).otherwise(F.log(1 - F.exp(tail)))


def battery(value: Column) -> Column:
    """struct<z_chi, z_runs, z_serial, log_p> of a token in its inferred encoding."""
    bare = F.regexp_replace(value, "=", "")

    def tests(alphabet: str, plain: Column, unevenness: float) -> Column:
        k = len(alphabet)
        n = F.greatest(F.char_length(plain), F.lit(2)).cast("double")
        squares = F.aggregate(
            F.split(F.lit(alphabet), ""), F.lit(0.0), lambda acc, s: acc + F.pow((F.char_length(plain) - F.char_length(F.replace(plain, s, F.lit("")))).cast("double"), F.lit(2.0))
        )
        chi, df = squares * k / n - n, float(k - 1)
        codes = F.transform(F.split(plain, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double"))
        middle, spread = (k - 1) / 2, (k * k - 1) / 12
        pairs = F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        turns = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + F.when((p["a"] > middle) != (p["b"] > middle), 1.0).otherwise(0.0))
        serial = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + (p["a"] - middle) * (p["b"] - middle)) / spread
        uneven = n * unevenness
        return F.struct(
            ((chi - df) / F.sqrt(2 * df * (n - 1) / n)).alias("z_chi"),
            ((turns - (n - 1) / 2) / F.sqrt((n - 1) / 4)).alias("z_runs"),
            (serial / F.sqrt(n - 1)).alias("z_serial"),
            normal_below((chi - df - uneven) / F.sqrt(2 * (df + 2 * uneven))).alias("log_p"),
        )

    out = None
    for alphabet, pattern, instead, unevenness in ENCODINGS:
        plain = F.translate(bare, "-_", instead)
        result, fits = tests(alphabet, plain, unevenness), bare.rlike(pattern)
        if not instead:
            fits = fits & (F.char_length(plain) >= LEAST_HEX)
        out = F.when(fits, result) if out is None else out.when(fits, result)
    return out


def length_class(n: Column) -> Column:
    out = F.lit(0)
    for i, least in enumerate(LENGTHS):
        out = F.when(n >= least, i).otherwise(out)
    return out


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base spans per kind, tokens) per row; tokens carry their length class and p-value bin.

    Only tokens that look random by all three tests have a bin; the others are counted as tested, at bin -1.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = with_spans(texts, [*BASE, TOKEN])
    tested = F.transform("s_random", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), battery(s["value"]).alias("t")))
    calm = lambda t: (t["z_chi"] <= Z_LIMIT) & (F.abs(t["z_runs"]) <= Z_LIMIT) & (F.abs(t["z_serial"]) <= Z_LIMIT)
    binned = F.transform(
        "tested",
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), length_class(s["end"] - s["start"]).alias("class"),
            F.when(calm(s["t"]), F.least(F.floor(-s["t"]["log_p"] * BIN), F.lit(BINS - 1)).cast("int")).otherwise(-1).alias("bin"),
        ),
    )
    rows = found.withColumn("tested", F.when(F.size("s_random") > 0, tested)).withColumn("tokens", F.when(F.size("s_random") > 0, binned))
    return rows.select("doc_id", *[f"s_{k.name}" for k in BASE], "tokens")


def cutoffs(scanned: DataFrame, share: float = FALSE_SHARE) -> dict[int, int]:
    """Per length class the lowest bin that Benjamini-Hochberg accepts, over all different tokens of the corpus.

    Equal tokens share class and bin, so the cutoff holds for all their copies. What reaches the driver is one count per class and bin, at most len(LENGTHS) * (BINS + 1) rows.
    """
    different = scanned.select(F.explode("tokens").alias("t")).select("t.class", "t.bin", F.sha2("t.value", 256).alias("value")).distinct()
    counts = different.groupBy("class", "bin").agg(F.count("*").alias("n")).collect()
    lowest = {}
    for c in range(len(LENGTHS)):
        bins = sorted(((r["bin"], r["n"]) for r in counts if r["class"] == c), reverse=True)
        total, passed = sum(n for _, n in bins), 0
        for b, n in bins:
            passed += n
            if b >= 0 and total * math.exp(-b / BIN) <= share * passed:
                lowest[c] = b
    return lowest


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row of docs.

    Null texts are empty; repeated rows each get their result; no row is joined or grouped by id.
    """
    scanned = write_out(scan(docs), "secret-scan")
    lowest = cutoffs(scanned)
    base = F.concat(*[F.col(f"s_{k.name}") for k in BASE])

    def passes(t: Column) -> Column:
        ok = F.lit(False)
        for c, b in lowest.items():
            ok = ok | ((t["class"] == c) & (t["bin"] >= b))
        return ok & ~F.exists("base", lambda s: (s["start"] <= t["start"]) & (t["end"] <= s["end"]))

    added = F.transform(
        F.filter(F.coalesce("tokens", F.array()), passes),
        lambda t: F.struct(t["start"].alias("start"), F.lit(len(BASE)).alias("rank"), t["end"].alias("end"), F.lit(TOKEN.name).alias("kind"), t["value"].alias("value")),
    )
    rows = scanned.withColumn("base", base).withColumn("added", F.when(F.col("tokens").isNull(), F.array().cast(SPAN)).otherwise(added.cast(SPAN)))
    return rows.select(
        "doc_id",
        *[F.size(f"s_{k.name}").cast("long").alias(f"n_{k.name}") for k in BASE],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_random"),
    )
