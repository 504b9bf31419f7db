"""Finding secrets: fixed patterns, and strings that look random to Markov models.

Two character Markov models are fitted on strings the patterns label in a bounded
sample of texts: the values they match are random strings, other
words of eight and more characters are ordinary identifiers.  Long
strings of letters and digits have no label: they are what the models judge.  Such a string
is a secret when it is far likelier under the first model.  The models are one array of 64 x 64 log ratios.

Everything is a column expression.  Positions come from marking the
matches: a control character is set around each, and the lengths of
the pieces between them add up to code point positions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import constant, let

# Fixed values of the patterns asked for.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs are matched whole, so asking for the length beforehand finds the same ones.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_VALUE = 8

# Strings the models judge: they must hold a letter and a digit.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
ORDINARY = r"[A-Za-z0-9+/_-]{8,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
_SIZE = len(ALPHABET)

#: Texts, in expectation, on which the models are fitted.
SAMPLE_TEXTS = 20_000
#: Nats by which the random model must be ahead, in all and per character.
AHEAD = 12.0
AHEAD_EACH = 0.5
# Weights of what unseen transitions fall back to: any character in random strings,
# in identifiers those that follow others there.
_RANDOM_WEIGHT, _ORDINARY_WEIGHT, _ORDINARY_EACH = 64.0, 6.4, 0.1

MASK = "[secret]"
#: Matches of one text that are listed at a time.
CHUNK = 128
RANDOM = 3
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _clear(text: Column) -> Column:
    """The text without the marking character, another one in its places."""
    return F.translate(F.coalesce(text, F.lit("")), "\u0001", "\u0002")


def _scanned(items: Column, kind: str, start: int, add: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column]) -> Column:
    """``emit(state, item)``, an array of type ``kind``, of all items in order, joined; ``add(state, item)`` is the next state, a number.

    States are first worked out chunk by chunk, by their ``add`` over states too, so that no long list is copied for each item it
    gains: the work follows the number of items.
    """
    empty = F.array().cast(kind)

    def chunk(part: Column, first: Column) -> Column:
        def step(state: Column, item: Column) -> Column:
            return F.struct(add(state["at"], item).alias("at"), F.concat(state["out"], emit(state["at"], item)).alias("out"))

        return F.aggregate(part, F.struct(first.alias("at"), empty.alias("out")), step, lambda state: state["out"])

    def whole(parts: Column) -> Column:
        last = F.transform(parts, lambda part: F.aggregate(part, F.lit(start), add))
        firsts = F.aggregate(last, F.array(F.lit(start)), lambda done, x: F.concat(done, F.array(_JOINS[add](F.element_at(done, -1), x))))
        return F.flatten(F.zip_with(parts, F.slice(firsts, 1, F.size(parts)), chunk))

    cut = lambda all_: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / CHUNK).cast("int")), lambda k: F.slice(all_, k * CHUNK + 1, CHUNK))
    return let(items, lambda all_: F.when(F.size(all_) > 0, let(cut(all_), whole)).otherwise(empty))


def _after(at: Column, piece: Column) -> Column:
    return at + F.length(piece["text"])


def _furthest(at: Column, event: Column) -> Column:
    return F.greatest(at, event["reach"])


# How the state of a chunk joins that of all before it.
_JOINS = {_after: lambda a, b: a + b, _furthest: lambda a, b: F.greatest(a, b)}


def _spans(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column]) -> Column:
    """Leftmost non-overlapping matches as (start, kind, end), those that ``keep`` passes."""
    empty = F.array().cast(_SPANS)

    def emit(at: Column, piece: Column) -> Column:
        span = F.struct(at.alias("start"), F.lit(kind).alias("kind"), _after(at, piece).alias("end"))
        return F.when(piece["hit"] & keep(piece["text"]), F.array(span)).otherwise(empty)

    # Marks stand around matches, so every second piece is one.
    pieces = F.split(F.regexp_replace(text, pattern, "\u0001$0\u0001"), "\u0001")
    marked = F.transform(pieces, lambda p, i: F.struct(p.alias("text"), (i % 2 == 1).alias("hit")))
    return F.when(text.rlike(pattern), _scanned(marked, _SPANS, 0, _after, emit)).otherwise(empty)


def _always(_: Column) -> Column:
    return F.lit(True)


def _base_spans(text: Column) -> Column:
    valued = lambda piece: F.length(F.regexp_extract(piece, ASSIGN, 2)) >= ASSIGN_VALUE
    return F.concat(_spans(text, ASSIGN, 0, valued), _spans(text, ACCESS, 1, _always), _spans(text, HEX, 2, _always))


def _mixed(word: Column) -> Column:
    return word.rlike("[0-9]") & word.rlike("[A-Za-z]")


def _pairs(word: Column) -> Column:
    """Numbers of the character pairs of a string, 64 * first + second."""
    places = F.transform(F.split(word, ""), lambda c: F.greatest(F.instr(F.lit(ALPHABET), c), F.lit(1)) - 1)
    return let(places, lambda at: F.zip_with(F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1), lambda a, b: a * _SIZE + b))


def _log_ratios(docs: DataFrame) -> Column:
    """Log ratios of the two models' transitions: a constant array of 4,096 numbers."""
    share = min(1.0, SAMPLE_TEXTS / max(1, docs.count()))
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))).select(
        _clear(F.col("text")).alias("text")
    )
    values = F.concat(
        F.transform(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), lambda v: v),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    ordinary = F.filter(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0)), lambda v: ~(v.rlike(CANDIDATE) & _mixed(v)))
    labelled = chosen.select(
        F.explode(
            F.concat(
                F.transform(F.filter(values, lambda v: F.length(v) >= ASSIGN_VALUE), lambda v: F.struct(v.alias("word"), F.lit(True).alias("random"))),
                F.transform(ordinary, lambda v: F.struct(v.alias("word"), F.lit(False).alias("random"))),
            )
        ).alias("sample")
    )
    pairs = labelled.select("sample.random", F.explode(_pairs(F.col("sample.word"))).alias("pair"))
    seen = pairs.groupBy("pair").agg(F.count_if("random").alias("r"), F.count_if(~F.col("random")).alias("o"))
    # 64 x 64 cells at most: gathered as one map, then laid out over all cells.
    cells = F.map_from_entries(F.collect_list(F.struct("pair", F.struct(F.col("r").cast("double").alias("r"), F.col("o").cast("double").alias("o")))))

    def laid_out(cells: Column) -> Column:
        places = F.sequence(F.lit(0), F.lit(_SIZE - 1))

        def at(pair: Column, field: str) -> Column:
            return F.coalesce(F.try_element_at(cells, pair)[field], F.lit(0.0))

        def total(values: Column) -> Column:
            return F.aggregate(values, F.lit(0.0), lambda t, x: t + x)

        def row(first: Column, seconds: Column) -> Column:
            """One first character: log ratios for all second ones; ``seconds`` are shares of second ones in identifiers."""
            random = F.transform(places, lambda second: at(first * _SIZE + second, "r"))
            ordinary = F.transform(places, lambda second: at(first * _SIZE + second, "o"))
            return let(
                F.struct(total(random).alias("r"), total(ordinary).alias("o")),
                lambda sums: F.zip_with(
                    random,
                    F.zip_with(ordinary, seconds, lambda n, share: F.struct(n.alias("n"), share.alias("share"))),
                    lambda r, o: F.log((r + _RANDOM_WEIGHT / _SIZE) / (sums["r"] + _RANDOM_WEIGHT))
                    - F.log((o["n"] + o["share"] * _ORDINARY_WEIGHT) / (sums["o"] + _ORDINARY_WEIGHT)),
                ),
            )

        seconds = F.transform(places, lambda second: total(F.transform(places, lambda first: at(first * _SIZE + second, "o"))))
        shares = let(seconds, lambda n: F.transform(n, lambda x: (x + _ORDINARY_EACH) / (total(n) + _ORDINARY_EACH * _SIZE)))
        return let(shares, lambda share: F.flatten(F.transform(places, lambda first: row(first, share))))

    return constant(seen.agg(let(cells, laid_out)).first()[0])


def _judged(text: Column, base: Column, ratios: Column) -> Column:
    """Spans of the strings the models call random, outside those of the patterns."""

    def random(piece: Column) -> Column:
        ahead = F.aggregate(_pairs(piece), F.lit(0.0), lambda total, pair: total + F.element_at(ratios, pair + 1))
        likelier = let(ahead, lambda a: (a >= AHEAD) & (a >= AHEAD_EACH * F.length(piece)))
        return _mixed(piece) & likelier

    found = _spans(text, CANDIDATE, RANDOM, random)
    return F.when(F.size(base) > 0, _outside(found, base)).otherwise(found)


def _outside(found: Column, base: Column) -> Column:
    """Those of ``found`` that overlap no span of ``base``, by one pass over all their ends and starts in order.

    Where a found span ends, whatever of ``base`` starts earlier has passed; it overlaps one if
    the furthest end among those lies behind its start.
    """
    none = F.lit(-1)
    passed = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("order"), b["end"].alias("reach"), none.alias("start"), none.alias("end")))
    asked = F.transform(found, lambda s: F.struct(s["end"].alias("at"), F.lit(0).alias("order"), none.alias("reach"), s["start"].alias("start"), s["end"].alias("end")))

    def emit(furthest: Column, event: Column) -> Column:
        span = F.struct(event["start"].alias("start"), F.lit(RANDOM).alias("kind"), event["end"].alias("end"))
        return F.when((event["order"] == 0) & (furthest <= event["start"]), F.array(span)).otherwise(F.array().cast(_SPANS))

    return _scanned(F.sort_array(F.concat(passed, asked)), _SPANS, 0, _furthest, emit)


def _found(docs: DataFrame) -> DataFrame:
    """The rows with ``_base`` and ``_all``: spans in order of start, then kind."""
    ratios = _log_ratios(docs.select("doc_id", "text"))
    spans = let(
        _clear(F.col("text")),
        lambda text: let(
            F.sort_array(_base_spans(text)),
            lambda base: F.struct(base.alias("base"), F.sort_array(F.concat(base, _judged(text, base, ratios))).alias("all")),
        ),
    )
    return docs.withColumn("_spans", spans)


def _listed(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ","
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row of ``docs`` (doc_id, text).

    Spans are ``kind:start:end`` in code points, end exclusive; the kind
    ``random`` holds what the models add, which never overlaps the patterns' spans.
    A NULL or empty text has no spans: an empty list, whose hash is that of an empty
    string.  Repeated rows and rows without an id are searched each; an empty table
    gives no rows; other columns are not looked at.
    """
    found = _found(docs.select("doc_id", "text"))

    def count(kind: int) -> Column:
        return F.size(F.filter("_spans.base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_listed(F.col("_spans.base")), 256).alias("base_sha256"),
        _listed(F.col("_spans.all")).alias("spans"),
    )


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mask; ``n_chars`` follows where there is one.

    Overlapping spans are masked together.  NULL texts stay NULL; texts without
    secrets, and all other columns, stay as they are.  Repeated rows are masked each; an empty table gives no rows.
    """
    # The row travels as one struct, so its columns' names meet no others.
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"))
    found = _found(rows.select("_row", F.col("_row.doc_id").alias("doc_id"), F.col("_row.text").alias("text")))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(F.col("text"), state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        piece = F.when(span["start"] >= state["at"], F.concat(gap, F.lit(MASK))).otherwise("")
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["out"], piece).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda state: F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, F.length("text")))
    masked = F.when(F.size("_spans.all") > 0, F.aggregate("_spans.all", start, step, rest)).otherwise(F.col("text"))
    out = found.select("_row", masked.alias("_masked"))
    new = {"text": F.col("_masked")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_masked").cast("bigint")
    return out.select(*(new[c].alias(c) if c in new else F.col("_row")[c].alias(c) for c in docs.columns))
