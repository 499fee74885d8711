"""Secret scans: fixed patterns, and random-looking strings found by a battery of tests.

Everything is a DataFrame expression over one document; only counts of p-values meet.
Positions are code points. A pattern's matches and the text between them, both from the
same pattern, give positions as running sums of lengths.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.session import stage

# The patterns, in the order in which kinds are listed. `needs` is the least
# length of `group`; the other two patterns carry their least length themselves, as a run
# that is too short fails as a whole.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST = 6
#: Strings that are tested for randomness. '=' only pads the end, so NAME=VALUE is two of them.
TOKEN = r"[A-Za-z0-9+/_-]{20,}=*"


@dataclass(frozen=True)
class Encoding:
    """An alphabet, the pattern of a string written in it without padding, and what tells
    natural strings of it from random ones.

    ``evenness``: K * sum(q^2) - 1 for their character shares q is ``excess``. ``mixing``: they
    seldom change between digits and letters. ``letters``: their letters are those of words.
    Empty: nothing does.
    """

    name: str
    pattern: str
    alphabet: str
    natural: tuple[str, ...]
    excess: float = 0.0


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: The first that fits counts.
ENCODINGS = (
    Encoding("decimal", r"^[0-9]+$", _DIGITS, ()),
    Encoding("hex", r"^([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef", ("mixing",)),
    Encoding("base32", r"^[A-Z2-7]+$", _UPPER + "234567", ("mixing", "letters")),
    Encoding("base36", r"^([0-9a-z]+|[0-9A-Z]+)$", _DIGITS + _LOWER, ("mixing", "letters")),
    Encoding("base64", r"^[A-Za-z0-9+/_-]+$", _UPPER + _LOWER + _DIGITS + "+/", ("evenness",), 3.2),
)
#: Chance that a natural string changes between digits and letters from one place to the next.
CHANGES = 0.1
#: Per mille of each letter in prose, a mean of European languages; rare ones are raised to 5.
PROSE = dict(zip(_LOWER, (81, 15, 30, 40, 140, 14, 17, 35, 75, 5, 8, 45, 25, 80, 60, 24, 5, 68, 70, 72, 40, 12, 14, 5, 11, 9)))
#: Letters of a word depend on each other, so their sum varies more than single draws would.
DEPENDENCE = 2.0
#: A random string passes all four tests with a probability of at least 1 - 4 * ALPHA.
ALPHA = 0.001
#: Share of false finds aimed at among the finds of the randomness tests, per encoding.
FALSE_DISCOVERIES = 0.01
#: p-values are counted in steps of 10^(-1/20), down to 10^-40.
STEPS, MOST_STEPS = 20, 800
#: Running sums are made in blocks, so that their cost stays linear in the matches.
BLOCK = 256


def bound(value: Column, function) -> Column:
    """``function`` of a value that is computed once, however often and in whatever loop the
    function names it. A plain column may be put back as its expression at each place."""
    return F.transform(F.array(value), function)[0]


def _running(values: Column, add) -> Column:
    """Inclusive running totals of an array of longs from 0, by an associative ``add``; in
    blocks, so that the cost stays linear in the length."""
    zero = F.lit(0).cast("long")

    def totals(items: Column, size) -> Column:
        return F.aggregate(items, F.array(zero), lambda acc, x: F.concat(acc, F.array(add(F.element_at(acc, -1), size(x)))))

    def joined(inner: Column) -> Column:
        before = totals(inner, lambda block: F.element_at(block, -1))
        whole = F.zip_with(inner, before, lambda block, o: F.transform(F.slice(block, F.lit(2), F.lit(BLOCK)), lambda x: add(x, o)))
        return F.flatten(F.filter(whole, lambda x: x.isNotNull()))

    def blocks(all_: Column) -> Column:
        last = F.greatest(F.floor((F.size(all_) - 1) / BLOCK), F.lit(0)).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(all_, b * BLOCK + 1, F.lit(BLOCK)))
        return F.transform(parts, lambda block: totals(block, lambda x: x))

    return bound(bound(values, blocks), joined)


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an array of longs."""
    return _running(values, lambda a, b: a + b)


def running_max(values: Column) -> Column:
    """Inclusive running maxima of an array of longs of 0 and more."""
    return _running(values, lambda a, b: F.greatest(a, b))


def _found(df: DataFrame, name: str, pattern: str) -> DataFrame:
    """Add ``name``: array of (start, end, match) for the matches of ``pattern`` in ``_t``."""
    df = df.withColumn("_m", F.regexp_extract_all("_t", F.lit(pattern), F.lit(0)))
    some = F.size("_m") > 0
    between = F.when(some, F.split("_t", pattern, -1))
    lengths = F.zip_with(F.slice(between, F.lit(1), F.size("_m")), F.col("_m"), lambda a, b: (F.char_length(a) + F.char_length(b)).cast("long"))
    df = df.withColumn("_lengths", lengths)
    df = df.withColumn("_ends", F.when(some, running_sums(F.col("_lengths"))))
    spans = F.zip_with(
        F.col("_ends"),
        F.col("_m"),
        lambda e, m: F.struct((e - F.char_length(m)).alias("start"), e.alias("end"), m.alias("match")),
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    return df.withColumn(name, F.coalesce(spans, empty)).drop("_m", "_lengths", "_ends")


def _erfc_tail(z: Column) -> Column:
    """P(Z > z) for z >= 0, by a rational approximation with an error below 7.5e-8 of the
    density; beyond that it behaves as density(z) / z, so small values stay in proportion."""
    t = 1.0 / (1.0 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2.0) * 0.3989422804014327 * poly


def normal_cdf(z: Column) -> Column:
    return F.when(z < 0, _erfc_tail(-z)).otherwise(1.0 - _erfc_tail(z))


def battery(token: Column) -> Column:
    """Struct of (encoding, p_random, p_text) for a string; null where no encoding fits.

    ``p_random``: the least p-value of four tests of "every character is drawn evenly
    from the alphabet": chi-squared uniformity, runs above and below the middle of the
    alphabet, correlation of neighbours, the share of digits. ``p_text``: how likely a natural
    string of this length is to be so even, or, where that says little at the length of
    keys, to mix digits and letters so much and have letters so rare. It shrinks with the
    length; a short string cannot reach a small value.
    """
    bare = F.rtrim(token, F.lit("="))
    result = F.lit(None)
    for code in reversed(ENCODINGS):
        result = F.when(bare.rlike(code.pattern), _counted(bare, code)).otherwise(result)
    return result


def _counted(bare: Column, code: Encoding) -> Column:
    """What the tests need of a string in this encoding."""
    n, k = F.char_length(bare).cast("double"), float(len(code.alphabet))
    plain = F.translate(F.lower(bare) if code.name in ("hex", "base36") else bare, "-_", "+/")
    letters = F.split(plain, "")

    def squared_count(total: Column, letter: Column) -> Column:
        rest = F.char_length(F.replace(plain, letter, F.lit("")))
        return total + F.pow((F.char_length(plain) - rest).cast("double"), F.lit(2.0))

    def walk(a: Column, v: Column) -> Column:
        high = v >= k / 2
        turned = (a["last"] < 0) | (high != (a["last"] >= k / 2))
        return F.struct(
            v.alias("last"),
            (a.high + F.when(high, 1.0).otherwise(0.0)).alias("high"),
            (a.runs + F.when(turned, 1.0).otherwise(0.0)).alias("runs"),
            (a.s + v).alias("s"),
            (a.ss + v * v).alias("ss"),
            (a.lag + F.when(a["last"] < 0, 0.0).otherwise(a["last"] * v)).alias("lag"),
        )

    lower = F.lower(bare)
    weights = F.array(*[F.lit(w) for w in _rarity()])

    def rarity(total: Column, letter: Column) -> Column:
        rest = F.char_length(F.replace(lower, letter, F.lit("")))
        at = F.instr(F.lit(_LOWER), letter)
        return total + F.when(at > 0, (F.char_length(lower) - rest) * F.get(weights, at - 1)).otherwise(0.0)

    nothing = F.lit(0.0)
    mixing, by_letters = "mixing" in code.natural, "letters" in code.natural
    chi = k * F.aggregate(F.array_distinct(letters), F.lit(0.0), squared_count) / n - n
    values = F.transform(letters, lambda c: (F.instr(F.lit(code.alphabet), c) - 1).cast("double"))
    start = F.struct(F.lit(-1.0).alias("last"), *[F.lit(0.0).alias(c) for c in ("high", "runs", "s", "ss", "lag")])
    return F.struct(
        F.lit(code.name).alias("encoding"),
        n.alias("n"),
        F.lit(code.excess).alias("excess"),
        F.lit(k).alias("k"),
        chi.alias("chi"),
        ((chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)).alias("z_even"),
        F.aggregate(values, start, walk).alias("walk"),
        (n - F.char_length(F.regexp_replace(plain, "[0-9]", ""))).alias("digits"),
        F.lit(sum(c.isdigit() for c in code.alphabet) / k).alias("digit_share"),
        (F.regexp_count(lower, F.lit("(?<=[0-9])[a-z]|(?<=[a-z])[0-9]")).cast("double") if mixing else nothing).alias("changes"),
        (F.aggregate(F.array_distinct(F.split(lower, "")), nothing, rarity) if by_letters else nothing).alias("rarity"),
        F.lit(mixing).alias("by_mixing"),
        F.lit(by_letters).alias("by_letters"),
    )


def _rarity() -> list[float]:
    """Per letter a to z the log of how much rarer it is in prose than in even draws."""
    total = sum(PROSE.values())
    return [math.log(total / (26 * n)) for n in PROSE.values()]


def _p_changes(changes: Column, places: Column) -> Column:
    """About P(X >= changes) for X binomial in ``places`` with ``CHANGES``: signed root of the
    likelihood ratio, half a change lower as X is whole."""
    x = F.greatest(changes - 0.5, F.lit(0.0)) / places
    ratio = F.when(x > 0, x * F.log(F.greatest(x, F.lit(1e-300)) / CHANGES)).otherwise(0.0) + (1 - x) * F.log((1 - x) / (1 - CHANGES))
    z = F.sqrt(F.greatest(2 * places * ratio, F.lit(0.0)))
    return F.when(x > CHANGES, normal_cdf(-z)).otherwise(normal_cdf(z))


def _p_letters(rarity: Column, n: Column) -> Column:
    """How likely ``n`` letters of prose are to be so rare in sum."""
    shares, weights = [c / sum(PROSE.values()) for c in PROSE.values()], _rarity()
    mean = sum(q * w for q, w in zip(shares, weights))
    spread = sum(q * w * w for q, w in zip(shares, weights)) - mean * mean
    return normal_cdf(-(rarity - n * mean) / F.sqrt(F.greatest(n, F.lit(1.0)) * (DEPENDENCE * spread)))


def _p_values(r: Column) -> Column:
    """(encoding, p_random, p_text) from what ``battery`` has counted."""
    n, w = r.n, r.walk
    mean_runs = 2 * w.high * (n - w.high) / n + 1
    var_runs = F.greatest((mean_runs - 1) * (mean_runs - 2) / F.greatest(n - 1, F.lit(1.0)), F.lit(1e-9))
    z_runs = (w.runs - mean_runs) / F.sqrt(var_runs)
    spread = w.ss - w.s * w.s / n
    corr = F.when(spread <= 0, 1.0).otherwise((w.lag - w.s * w.s / n) / F.greatest(spread, F.lit(1e-9)))
    z_corr = (corr + 1.0 / n) * F.sqrt(n)
    z_digits = (r.digits - n * r.digit_share) / F.sqrt(F.greatest(n * r.digit_share * (1 - r.digit_share), F.lit(1e-9)))
    p_random = F.least(
        1.0 - normal_cdf(r.z_even), *[2.0 * (1.0 - normal_cdf(F.abs(z))) for z in (z_runs, z_corr, z_digits)]
    )
    # Natural strings: chi-squared with a shift of n * excess.
    shift = n * r.excess
    p_even = normal_cdf((r.chi - (r.k - 1) - shift) / F.sqrt(2 * (r.k - 1) + 4 * shift))
    # Two tests count by the product of their values, whose own law is x * (1 - log(x)).
    p_mixed = _p_changes(r.changes, n - 1)
    both = F.greatest(p_mixed * _p_letters(r.rarity, n - r.digits), F.lit(1e-300))
    p_text = (
        F.when(r.by_letters, both * (1 - F.log(both)))
        .when(r.by_mixing, p_mixed)
        .when(r.excess > 0, p_even)
        .otherwise(1.0)
    )
    return F.struct(r.encoding.alias("encoding"), p_random.alias("p_random"), p_text.alias("p_text"))


def _spans(found: Column, rank: int) -> Column:
    """Spans of one kind in the form in which they sort: by start, then by kind."""
    return F.transform(
        found,
        lambda x: F.struct(
            x.start.alias("start"), F.lit(rank).alias("rank"), x.end.alias("end"), F.lit(KINDS[rank]).alias("kind")
        ),
    )


def scan(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Per document ``base`` and ``tested``: the pattern spans, and the strings tested with
    their p-values. Null text counts as empty."""
    df = docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    for name, pattern in (("_assign", ASSIGN), ("_access", ACCESS), ("_hex", HEX), ("_token", TOKEN)):
        df = _found(df, name, pattern)
    long_enough = F.filter("_assign", lambda x: F.char_length(F.regexp_extract(x["match"], ASSIGN, 2)) >= ASSIGN_LEAST)
    base = [_spans(found, rank) for rank, found in enumerate((long_enough, F.col("_access"), F.col("_hex")))]
    df = df.select(*keys, F.sort_array(F.concat(*base)).alias("base"), "_token")
    df = _with_free(df, keys)
    df = df.select(*keys, "base", F.transform("_free", lambda x: F.struct(x.start.alias("start"), x.end.alias("end"), battery(x["match"]).alias("r"))).alias("_r"))
    rated = F.transform(
        F.filter("_r", lambda x: x.r.isNotNull()),
        lambda x: F.struct(x.start.alias("start"), x.end.alias("end"), _p_values(x.r).alias("p")),
    )
    return df.select(*keys, "base", rated.alias("tested"))


def _with_free(df: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` and ``_free``: the tokens that no base span overlaps.

    Spans and tokens are sorted together. A token is free when no base span before it reaches
    beyond its start, and none after it starts before its end: running maxima from either
    side, so the work is in proportion to spans and tokens.
    """
    both = (F.size("base") > 0) & (F.size("_token") > 0)
    spans = F.transform("base", lambda s: F.struct(s.start.alias("start"), F.lit(0).alias("order"), s.end.alias("end"), F.lit("").alias("match")))
    tokens = F.transform("_token", lambda s: F.struct(s.start.alias("start"), F.lit(1).alias("order"), s.end.alias("end"), s["match"].alias("match")))
    df = df.select(*keys, "base", "_token", F.when(both, F.sort_array(F.concat(spans, tokens))).alias("_all"))
    zero, far = F.lit(0).cast("long"), F.lit(1 << 40)
    reached = F.transform("_all", lambda x: F.when(x.order == 0, x.end).otherwise(zero))
    # How far before the end of all texts the next base span starts, from the right.
    ahead = F.transform(F.reverse("_all"), lambda x: F.when(x.order == 0, far - x.start).otherwise(zero))
    df = df.withColumns({"_reached": F.when(both, running_max(reached)), "_ahead": F.when(both, F.reverse(running_max(ahead)))})
    marked = F.arrays_zip("_all", "_reached", "_ahead")
    alone = F.filter(marked, lambda z: (z["_all"].order == 1) & (z["_reached"] <= z["_all"].start) & (far - z["_ahead"] >= z["_all"].end))
    free = F.transform(alone, lambda z: F.struct(z["_all"].start.alias("start"), z["_all"].end.alias("end"), z["_all"]["match"].alias("match")))
    return df.select(*keys, "base", F.coalesce(free, F.col("_token")).alias("_free"))


def _step(p: Column) -> Column:
    return F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * STEPS), F.lit(MOST_STEPS)).cast("int")


def discovery_steps(scanned: DataFrame, level: float = FALSE_DISCOVERIES) -> dict[str, int]:
    """Per encoding the least step of p at which the expected share of false finds is within
    ``level``.

    The step-up rule over all strings of an encoding in all documents: with m tested and N
    at or below p, p is allowed when p * m <= level * N. Long words of one encoding so cost
    the others nothing. Counts by step are at most ``MOST_STEPS`` + 1 rows per encoding.
    """
    p = scanned.select(F.explode("tested.p").alias("p"))
    counts = p.groupBy("p.encoding", _step(F.col("p.p_text")).alias("step")).count().collect()
    steps = {}
    for encoding in {r["encoding"] for r in counts}:
        found = {r["step"]: r["count"] for r in counts if r["encoding"] == encoding}
        tested, reached = sum(found.values()), 0
        steps[encoding] = MOST_STEPS + 1
        for step in sorted(found, reverse=True):
            reached += found[step]
            if 10.0 ** (-step / STEPS) * tested <= level * reached:
                steps[encoding] = step
    return steps


def find_secrets(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Per document ``base`` and ``spans``: arrays of (start, rank, end, kind), by start.

    One pass over the texts leaves a small table; a second reads it. A repeated document
    counts each time. Documents without finds have empty arrays; an empty table gives an
    empty result. Only ``keys`` and ``text`` are read. Not found: random strings of one
    class, such as decimal digits or small letters alone, which nothing here tells from
    numbers and words.
    """
    scanned = stage(scan(docs, keys, text), "secret-scan")
    steps = discovery_steps(scanned)

    def is_find(x: Column) -> Column:
        least = F.lit(MOST_STEPS + 1)
        for encoding, step in sorted(steps.items()):
            least = F.when(x.p.encoding == encoding, step).otherwise(least)
        return (x.p.p_random >= ALPHA) & (_step(x.p.p_text) >= least)

    random = _spans(F.filter("tested", is_find), 3)
    return scanned.select(*keys, "base", F.sort_array(F.concat("base", random)).alias("spans"))


def spans_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span, overlapping ones merged, replaced by ``mark``.

    All columns stay as they are but ``text``. Null texts stay null. The work in one text is in
    proportion to its length and its spans: pieces are cut out of an encoding of four bytes
    a character, where a place is found without counting from the start.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(text).alias("_text"))
    df = find_secrets(packed, ["_doc"], "_text")
    body = F.col(f"_doc.{text}")
    some = F.size("spans") > 0
    zero = F.array(F.lit(0).cast("long"))
    # Runs of text to keep: from the furthest end so far to the next start.
    reach = F.concat(zero, running_max(F.transform("spans", lambda s: s.end)))

    def cut(d: Column) -> Column:
        def piece(first: Column, end: Column) -> Column:
            return F.decode(F.substring(d.wide, (first * 4 + 1).cast("int"), ((end - first) * 4).cast("int")), "UTF-32")

        kept = F.zip_with(
            d.spans,
            F.slice(d.reach, F.lit(1), F.size(d.spans)),
            lambda s, r: F.when(s.start >= r, F.concat(piece(r, s.start), F.lit(mark))).otherwise(F.lit("")),
        )
        return F.concat(F.array_join(kept, ""), piece(F.element_at(d.reach, -1), d.n))

    whole = F.struct(
        F.encode(body, "UTF-32").alias("wide"), reach.alias("reach"), F.col("spans").alias("spans"), F.char_length(body).cast("long").alias("n")
    )
    clean = F.when(some, bound(whole, cut)).otherwise(body)
    return df.select(*[clean.alias(c) if c == text else F.col(f"_doc.`{c}`") for c in docs.columns])
