"""Secrets in texts: fixed patterns, and random-looking tokens by two character Markov models.

Everything is built-in column functions. The patterns give spans by the lengths of what
lies between their matches. Other long tokens are scored by the log-likelihood ratio of two
first-order models over character pairs, one of random strings, one of ordinary identifiers;
both are counted from labelled samples with one grouped aggregate, and the table of
ratios is a literal of at most 128 x 128 numbers.

A null text is empty and has no spans; spans of repeated rows repeat. Spans count code
points, ends exclusive. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

#: Kinds in the order in which spans that start together are listed.
BASE_KINDS = ("assign", "access", "hex")
MARKOV = "markov"

# The look-around only spares the engine attempts that cannot match.
_ASSIGN = (
    r"""(?=[pPsStTaA])((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = r"AKIA[A-Z0-9]{14,}"
_HEX = r"[0-9a-f]{16,}"
#: Tokens that the models judge: runs of these characters, of this length or more.
TOKEN_CHARACTERS = "A-Za-z0-9+/_-"
MIN_TOKEN = 16
#: Log-likelihood ratio from which a token counts as random: e**6 times as likely as an ordinary one.
MIN_RATIO = 6.0
#: Weight of the kinds of two characters against the pair itself.
KIND_SHARE = 0.4
#: Texts whose tokens and words train the model of identifiers, and as many random strings of each form.
TRAINING_TEXTS = 500
_SHORT = f"(?<![{TOKEN_CHARACTERS}])[{TOKEN_CHARACTERS}]{{3,{MIN_TOKEN - 1}}}(?![{TOKEN_CHARACTERS}])"
_CODES = 128
_ALPHABET = "+/_-" + "".join(chr(c) for c in range(_CODES) if chr(c).isalnum())
_BLOCK = 256


def _sums(array: Column) -> Column:
    """0 and the running sums of an array of longs."""
    start = F.array(F.lit(0).cast("bigint"))
    return F.aggregate(array, start, lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))


_SPANS = "array<struct<start: bigint, end: bigint>>"


def add_spans(rows: DataFrame, kinds: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds, per kind of (matches, pattern), the (start, end) of each match in the column text.

    A match ends at the sum of all matches up to it and of the pieces of text between them.
    The sums run in blocks, so long arrays do not cost a square. Every step is a column of its
    own, as each refers to the one before several times.
    """
    lengths, steps, blocks, bases, spans = {}, {}, {}, {}, {}
    for kind, (matches, pattern) in kinds.items():
        none = F.array().cast("array<bigint>")
        pieces = F.transform(F.split("text", pattern, -1), lambda p: F.length(p).cast("bigint"))
        lengths[f"{kind}_lengths"] = F.transform(matches, lambda m: F.length(m).cast("bigint"))
        own, step, block = F.col(f"{kind}_lengths"), F.col(f"{kind}_steps"), F.col(f"{kind}_blocks")
        base = F.col(f"{kind}_bases")
        # The text is split only if there are matches; the last piece follows the last match.
        steps[f"{kind}_steps"] = F.when(
            F.size(own) > 0, F.zip_with(own, F.slice(pieces, F.lit(1), F.size(own)), lambda m, g: m + g)
        ).otherwise(none)
        starts = F.when(F.size(step) > 0, F.sequence(F.lit(1), F.size(step), F.lit(_BLOCK)))
        blocks[f"{kind}_blocks"] = _blocks(step, starts)
        bases[f"{kind}_bases"] = _sums(F.transform(block, lambda b: F.element_at(b, -1)))
        ends = F.flatten(
            F.zip_with(
                block,
                F.slice(base, F.lit(1), F.size(block)),
                lambda b, low: F.transform(F.slice(b, F.lit(2), F.size(b) - 1), lambda v: v + low),
            )
        )
        spans[kind] = F.zip_with(
            ends, own, lambda e, m: F.struct((e - m).alias("start"), e.alias("end"))
        ).cast(_SPANS)
    helpers = [*lengths, *steps, *blocks, *bases]
    for columns in (lengths, steps, blocks, bases, spans):
        rows = rows.withColumns(columns)
    return rows.drop(*helpers)


def _blocks(step: Column, starts: Column) -> Column:
    return F.transform(
        F.coalesce(starts, F.array().cast("array<int>")),
        lambda at: _sums(F.slice(step, at, F.lit(_BLOCK))),
    )


def base_spans(rows: DataFrame) -> DataFrame:
    """Adds the spans of the fixed patterns to rows with a column text, one array per kind."""
    found = rows.withColumns(
        {
            "assign_all": F.regexp_extract_all("text", F.lit(_ASSIGN), F.lit(0)),
            "access_all": F.regexp_extract_all("text", F.lit(_ACCESS), F.lit(0)),
            "hex_all": F.regexp_extract_all("text", F.lit(_HEX), F.lit(0)),
        }
    )
    found = add_spans(
        found,
        {
            "assign_spans": ("assign_all", _ASSIGN),
            "access": ("access_all", _ACCESS),
            "hex": ("hex_all", _HEX),
        },
    )
    value = F.transform("assign_all", lambda m: F.length(F.regexp_extract(m, _ASSIGN, 2)))
    located = F.arrays_zip(F.col("assign_spans").alias("span"), value.alias("length"))
    long_enough = F.transform(F.filter(located, lambda s: s["length"] >= 12), lambda s: s["span"])
    return found.withColumn("assign", long_enough).drop("assign_all", "assign_spans", "access_all", "hex_all")


def training_samples(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Labelled tokens (token, random): ordinary ones from some texts, and digests of these texts.

    Ordinary are the short tokens of the texts as they stand, and identifiers made from
    neighbouring words: camel, snake and kebab case, constants, paths, names with numbers, numbers,
    dates, UUIDs, rules and fill. Random are digests written in the alphabets of keys. Lower-case
    digits in base sixteen are not among them: alone they match the pattern of hex strings, and
    otherwise they are parts of identifiers. The sample is bounded: the ``TRAINING_TEXTS`` texts of
    smallest hash.
    """
    rows = docs.select(docs[text_column].alias("text")).filter(F.length("text") > 0)
    rows = rows.withColumn("key", F.xxhash64("text"))
    # Keys are chosen without their texts, so the last step gathers a few bytes per task and row.
    keys = rows.select(F.col("key").alias("chosen")).distinct().orderBy("chosen").limit(TRAINING_TEXTS)
    chosen = rows.join(F.broadcast(keys), F.col("key") == F.col("chosen"), "left_semi").distinct()
    short = F.regexp_extract_all("text", F.lit(_SHORT), F.lit(0))
    natural = chosen.select(F.explode(F.array_distinct(short)).alias("token")).distinct()
    words = F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Za-z]{3,15}"), F.lit(0)))
    neighbours = F.zip_with(
        "words",
        F.slice("words", F.lit(2), F.greatest(F.size("words") - 1, F.lit(0))),
        lambda a, b: F.struct(a.alias("word"), F.coalesce(b, a).alias("other")),
    )
    pairs = (
        chosen.select(words.alias("words"))
        .select(F.explode(neighbours).alias("pair"))
        .groupBy(F.col("pair.word").alias("word"))
        .agg(F.min("pair.other").alias("other"))
    )
    made = pairs.select(F.explode(_identifiers(F.col("word"), F.col("other"))).alias("token"))
    ordinary = natural.unionAll(made).select("token", F.lit(False).alias("random"))
    digest = F.sha2("text", 512)
    forms = F.array(
        F.regexp_replace(F.base64(F.unhex(digest)), "=", ""),
        F.translate(F.regexp_replace(F.base64(F.unhex(F.sha2(F.reverse("text"), 512))), "=", ""), "+/", "-_"),
        F.translate(F.base64(F.unhex(F.sha2(F.concat("text", F.lit("0")), 512))), "+/=", ""),
        F.upper(digest),
        F.translate(F.upper(F.base64(F.unhex(F.sha2(F.upper("text"), 512)))), "+/=", "Q7"),
        F.translate(F.lower(F.base64(F.unhex(F.sha2(F.lower("text"), 512)))), "+/=", "q7"),
    )
    random = chosen.select(F.explode(forms).alias("token"), F.lit(True).alias("random"))
    return ordinary.unionAll(random)


def _identifiers(word: Column, other: Column) -> Column:
    """Ordinary tokens of the usual forms from two words; what is not letters comes from a hash."""
    number = F.pmod(F.xxhash64(word), F.lit(10**16))
    small = F.pmod(number, F.lit(100)).cast("string")
    moment = F.timestamp_seconds(F.pmod(number, F.lit(2 * 10**9)))
    digest = F.md5(word)
    uuid = F.concat_ws("-", *[F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    letter = F.substring(F.lit(_ALPHABET), F.pmod(number, F.lit(len(_ALPHABET))).cast("int") + 1, 1)
    low, next_low = F.lower(word), F.lower(other)
    return F.array(
        word,
        low,
        F.upper(word),
        F.concat_ws("_", word, next_low),
        F.concat_ws("_", F.upper(word), F.upper(other)),
        F.concat_ws("_", low, small),
        F.concat_ws("-", low, next_low, small),
        F.concat_ws("-", F.initcap(low), F.initcap(next_low)),
        F.concat(low, F.initcap(next_low), F.initcap(low)),
        F.concat(F.initcap(low), F.initcap(next_low), small),
        F.concat_ws("/", low, next_low, F.initcap(low)),
        F.concat(F.lit("/"), next_low, F.lit("/"), low, small),
        F.lpad(number.cast("string"), 16, "0"),
        F.date_format(moment, "yyyy-MM-dd'T'HH-mm-ss"),
        F.date_format(moment, "yyyy/MM/dd/HHmmss"),
        F.date_format(moment, "yyyyMMdd'T'HHmmss'Z'"),
        uuid,
        F.repeat(letter, 8),
    )


def _codes(token: Column) -> Column:
    """The ASCII characters of a token as numbers."""
    return F.filter(F.transform(F.split(token, "", -1), F.ascii), lambda c: (c > 0) & (c < _CODES))


def _pairs(codes: Column) -> Column:
    """Number of each pair of neighbouring characters, first * 128 + second."""
    count = F.greatest(F.size(codes) - 1, F.lit(0))
    first, second = F.slice(codes, F.lit(1), count), F.slice(codes, F.lit(2), count)
    return F.zip_with(first, second, lambda a, b: a * _CODES + b)


def train(samples: DataFrame) -> list[float]:
    """The log-likelihood ratio of each pair of characters, random against ordinary.

    The probability of a character behind another is its share there, mixed with what the kinds
    of both (lower, upper, digit, other) say, so that a pair of letters the samples lack is not
    taken as random. Without samples every ratio is 0.
    """
    counts = (
        samples.select("random", _codes(F.col("token")).alias("codes"))
        .select("random", F.explode(_pairs(F.col("codes"))).alias("pair"))
        .groupBy("random", "pair")
        .count()
        .collect()  # at most 2 * 128 * 128 rows
    )
    seen = {(row["random"], row["pair"]): row["count"] for row in counts}
    random, ordinary = [_probabilities({p: n for (kind, p), n in seen.items() if kind is k}) for k in (True, False)]
    ratios = [0.0] * (_CODES * _CODES)
    for pair, share in random.items():
        ratios[pair] = math.log(share) - math.log(ordinary[pair])
    return ratios


def _kind(code: int) -> str:
    character = chr(code)
    return "digit" if character.isdigit() else "lower" if character.islower() else "upper" if character.isupper() else ""


def _probabilities(seen: dict[int, int]) -> dict[int, float]:
    """Of each pair of token characters, the probability of the second behind the first."""
    codes = [ord(c) for c in _ALPHABET]
    sizes = Counter(_kind(c) for c in codes)
    kinds: Counter[tuple[str, str]] = Counter()
    for first in codes:
        for second in codes:
            kinds[_kind(first), _kind(second)] += seen.get(first * _CODES + second, 0)
    result = {}
    for first in codes:
        own = sum(seen.get(first * _CODES + c, 0) for c in codes)
        alike = sum(kinds[_kind(first), kind] for kind in sizes)
        weight = KIND_SHARE * own + len(codes)
        for second in codes:
            size = sizes[_kind(second)]
            by_kind = (kinds[_kind(first), _kind(second)] / size + 1) / (alike + len(codes))
            count = seen.get(first * _CODES + second, 0)
            result[first * _CODES + second] = (count + weight * by_kind) / (own + weight)
    return result


def ratio(token: Column, ratios: list[float]) -> Column:
    """The log-likelihood ratio of a token: positive if it looks random."""
    # A literal in one piece; as thousands of literals it would be thousands of plan nodes.
    table = F.split(F.lit(",".join(f"{r:.4f}" for r in ratios)), ",").cast("array<double>")
    score = F.transform(
        F.array(_codes(token)),
        lambda codes: F.aggregate(_pairs(codes), F.lit(0.0), lambda total, pair: total + F.get(table, pair)),
    )
    return F.get(score, F.lit(0))


_CODE = 1 << 31


def find_secrets(
    docs: DataFrame,
    ratios: list[float],
    id_column: str = "doc_id",
    text_column: str = "text",
    min_ratio: float = MIN_RATIO,
) -> DataFrame:
    """One row per row of ``docs``: its id and arrays of spans, ``assign access hex markov``.

    A random-looking token with exactly the span of a pattern's match is not listed again.
    """
    rows = docs.select(docs[id_column], F.coalesce(docs[text_column], F.lit("")).alias("text"))
    found = base_spans(rows)
    run = f"[{TOKEN_CHARACTERS}]"
    pattern = f"(?<!{run}){run}{{{MIN_TOKEN},}}"
    found = found.withColumn("tokens", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    found = add_spans(found, {"token_spans": ("tokens", pattern)})
    judged = F.arrays_zip(
        F.col("token_spans").alias("span"),
        F.transform("tokens", lambda t: ratio(t, ratios)).alias("ratio"),
    )
    random = F.transform(F.filter(judged, lambda s: s["ratio"] >= min_ratio), lambda s: s["span"])
    # As single numbers, array_except compares by hash.
    coded = lambda spans: F.transform(spans, lambda s: s["start"] * _CODE + s["end"])
    base = coded(F.concat("assign", "access", "hex"))
    fresh = F.transform(
        F.array_except(coded(random), base),
        lambda c: F.struct(
            F.floor(c / F.lit(_CODE)).cast("bigint").alias("start"), F.pmod(c, F.lit(_CODE)).cast("bigint").alias("end")
        ),
    )
    return found.select(id_column, "assign", "access", "hex", fresh.alias(MARKOV))


def listed(kinds: tuple[str, ...]) -> Column:
    """All spans of the given kinds as text, kind:start:end by start, then kind as given."""

    def numbered(number: int) -> Column:
        return F.transform(
            kinds[number],
            lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")),
        )

    rows = F.concat(*[numbered(number) for number in range(len(kinds))])
    names = F.array(*[F.lit(kind) for kind in kinds])
    return F.array_join(
        F.transform(
            F.array_sort(rows),
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )
