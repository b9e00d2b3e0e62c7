"""Collocations: a corpus's tightest two- and three-word phrases, by best-first branch and bound.

Phrases grow a word at a time. A phrase p of count a, cut into parts of counts
l and r, scores floor(1000000 * a * a / (l * r)), its lowest cut counting. What
is known of a prefix bounds all that grows from it:

* a prefix seen fewer than ``least`` times has no candidates below it, so a
  pair is counted only if both its words are frequent enough, and a triple only
  if both its pairs are;
* a triple that starts with a pair of count b occurs at most b times and its
  last two words at least as often as the triple itself, so it scores at most
  floor(1000000 * b / l), l being the count of its first word.

The frontier of a language is all its pairs with that bound. Those are expanded
(the triples below them counted) whose bound reaches the language's bar; for
pairs that reach the bar themselves the triples that end with them are counted
too, for these decide whether the pair is covered by a longer phrase. If as
many candidates as are wanted survive at or above the bar, nothing unexpanded
can come before them or tie with them, and the language is settled. Otherwise
the bar goes down to a later place in the list of pairs and at last to 0. The
first bar is the score of the pair at twice the wanted place.

Counts are exact and taken over all whole texts. Tasks count a block of text at
a time in numpy and send (words, count) rows, which meet in partial and final
sums. What tells tasks which words and pairs to send are bitmaps of a fixed
size; a bit set by chance costs a row more and changes no result. Words of a
language are told apart by 64-bit hashes. Scores are computed as decimals of 38
digits: counts up to 10**15 can't overflow them.

Defined results: a null text is empty, a null language is ``und``; texts without
words, and languages without a candidate, give no rows; repeated rows count as
often as they occur; ties are ranked by count, then by the phrase's bytes; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arspark.llm.common import Scratch, released
from arspark.llm.text import LOWER, Words, as_bytes, blocks, mix, odd

#: Bytes of text counted at once; binary logarithm of a bitmap's 64-bit words; parts that a language's ranking is dealt over.
BLOCK, MAP_BITS, SALTS = 1 << 21, 20, 64
#: Places in a language's list of pairs, as multiples of the phrases wanted, that set its bars; after the last the bar is 0.
BARS = (2, 16)

#: Bytes that end a piece of text, and those that are parts of words.
BREAK = np.zeros(256, dtype=bool)
BREAK[[ord(c) for c in ".,;:!?"]] = BREAK[10:14] = True
WORD = ~BREAK
WORD[[9, 32]] = False


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, np.ndarray, list[str], np.ndarray]]:
    """Of each block: its words, ids of (language, word), the languages, and the language of each word."""
    for batch in batches:
        raw, off = as_bytes(batch.column("text"))
        lang = batch.column("lang").dictionary_encode()
        names = lang.dictionary.to_pylist()
        seeds = np.array([xxhash.xxh3_64_intdigest(x.encode()) | 1 for x in names], dtype=np.uint64)
        code = lang.indices.to_numpy()
        for i, j in blocks(off, BLOCK):
            w = Words(raw, off, i, j, WORD)
            of = np.repeat(code[i:j], np.diff(w.first))
            if len(of):
                yield w, mix(w.hash * seeds[of] + odd(21)), names, of


def _linked(w: Words) -> np.ndarray:
    """For each word but the last, whether the next one belongs to the same piece."""
    ends = np.cumsum(BREAK[w.data], dtype=np.int32)
    row = w.rows_of()
    return (ends[w.starts[1:]] == ends[w.ends[:-1] - 1]) & (row[1:] == row[:-1])


def _tallied(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the first of each distinct value, and how many there are."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return order[head], np.diff(np.append(head, len(k)))


def _strings(w: Words, at: np.ndarray) -> pa.Array:
    """The words at these places, lower-cased."""
    size = w.ends[at] - w.starts[at]
    off = np.concatenate([[0], np.cumsum(size)])
    take = np.repeat(w.starts[at] - off[:-1], size) + np.arange(off[-1])
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(w.data[take])).cast(pa.string())


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for w, u, names, of in _blocks(batches):
        at, n = _tallied(u)
        yield pa.RecordBatch.from_arrays([_long(u[at]), pa.array(names, pa.string()).take(pa.array(of[at])), _strings(w, at), pa.array(n)], ["u", "lang", "word", "c"])


def _pair(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """An id of two ids, which :func:`_pair_col` makes too."""
    return u ^ (v << np.uint64(23) | v >> np.uint64(41))


def _pair_col(u: str, v: str) -> Column:
    return F.col(u).bitwiseXOR(F.shiftleft(v, 23).bitwiseOR(F.shiftrightunsigned(v, 41)))


def _set(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (bits[(h >> np.uint64(64 - MAP_BITS)).astype(np.int64)] >> (h >> np.uint64(58 - MAP_BITS) & np.uint64(63)) & np.uint64(1)).astype(bool)


def _bitmaps(rows: DataFrame, h: Column, **flags: Column) -> dict[str, np.ndarray]:
    """A bitmap of the hashes ``h`` for each flag; as many rows as a bitmap has words reach the driver at most."""
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {58 - MAP_BITS}) & 63L AS int))")
    marks = rows.select(h.alias("h"), *(f.alias(k) for k, f in flags.items())).select(
        F.shiftrightunsigned("h", 64 - MAP_BITS).cast("int").alias("at"), *(F.when(F.col(k), bit).alias(k) for k in flags))
    found = marks.groupBy("at").agg(*(F.coalesce(F.bit_or(k), F.lit(0)).cast("long").alias(k) for k in flags)).toArrow()
    out = {}
    for k in flags:
        out[k] = np.zeros(1 << MAP_BITS, dtype=np.uint64)
        out[k][found.column("at").to_numpy()] = found.column(k).to_numpy().view(np.uint64)
    return out


def _pairs(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = sent.value
        for w, u, _, _ in _blocks(batches):
            some = _set(often, u)
            k = np.flatnonzero(_linked(w) & some[:-1] & some[1:])
            at, n = _tallied(mix(_pair(u[k], u[k + 1])))
            k = k[at]
            yield pa.RecordBatch.from_arrays([_long(u[k]), _long(u[k + 1]), pa.array(n)], ["u1", "u2", "c"])
    return run


def _triples(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, grow, decide = sent.value
        for w, u, _, _ in _blocks(batches):
            linked = _linked(w)
            pair = _pair(u[:-1], u[1:])
            good = linked & _set(often, pair)
            k = np.flatnonzero(good[:-1] & good[1:])
            k = k[_set(grow, pair[k]) | _set(decide, pair[k + 1])]
            at, n = _tallied(mix(_pair(mix(pair[k]), u[k + 2])))
            k = k[at]
            yield pa.RecordBatch.from_arrays([_long(u[k]), _long(u[k + 1]), _long(u[k + 2]), pa.array(n)], ["u1", "u2", "u3", "c"])
    return run


def _ratio(top: str, bottom: str) -> str:
    return f"CAST((CAST(1000000 AS DECIMAL(7,0)) * {top}) div ({bottom}) AS BIGINT)"


def _big(c: str) -> str:
    return f"CAST({c} AS DECIMAL(15,0))"


def _score(a: str, left: str, right: str) -> Column:
    return F.expr(_ratio(f"{_big(a)} * {_big(a)}", f"{_big(left)} * {_big(right)}"))


def _first(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of each language with their ``rank``: each of several parts sends its first k."""
    part = Window.partitionBy("lang", "__part").orderBy(*order)
    some = rows.withColumn("__part", F.pmod(F.xxhash64("u1", "u2", "u3"), F.lit(SALTS))).withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= k).drop("__part")


def _with_words(pairs: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """Pairs with the language and the counts of both words as l and r."""
    hot = words.filter(F.col("c") * 1000 >= total)  # at most 1000 words make up a thousandth of all each
    for key, out in (("u1", "l"), ("u2", "r")):
        near = F.broadcast(hot.select(F.col("u").alias("__hot"), F.col("c").alias("__hc"), F.col("lang").alias("__hl")))
        pairs = pairs.join(near, F.col(key) == F.col("__hot"), "left")
        # pairs of a hot word are dealt out at random: they have its count already
        pairs = pairs.withColumn("__key", F.when(F.col("__hc").isNull(), F.col(key)).otherwise(F.xxhash64("u1", "u2")))
        pairs = pairs.join(words.select(F.col("u").alias("__key"), F.col("c").alias("__c"), F.col("lang").alias("__l")), "__key", "left")
        pairs = pairs.withColumn(out, F.coalesce("__hc", "__c"))
        if out == "l":
            pairs = pairs.withColumn("lang", F.coalesce("__hl", "__l"))
        pairs = pairs.drop("__hot", "__hc", "__hl", "__key", "__c", "__l")
    return pairs


def _bars(pairs: DataFrame, langs: DataFrame, place: int | None) -> DataFrame:
    """(lang, bar) of ``langs``: the score of the pair at that place, 0 if there is none."""
    if place is None:
        return langs.select("lang", F.lit(0).cast("long").alias("bar"))
    top = _first(pairs.join(langs.select("lang"), "lang", "left_semi").select("lang", "score", "u1", "u2", F.lit(0).alias("u3")), place, F.col("score").desc())
    return top.groupBy("lang").agg(F.when(F.count(F.lit(1)) < place, F.lit(0)).otherwise(F.min("score")).cast("long").alias("bar"))


def _expanded(rows: DataFrame, pairs: DataFrame, bars: DataFrame, least: int, cover: int, scratch: Scratch) -> DataFrame:
    """Surviving candidates of the languages in ``bars`` that reach their bar."""
    spark = rows.sparkSession
    known = scratch.save(pairs.join(bars, "lang"))
    bits = _bitmaps(known, _pair_col("u1", "u2"), often=F.lit(True), grow=F.col("bound") >= F.col("bar"), decide=F.col("score") >= F.col("bar"))
    sent = spark.sparkContext.broadcast(tuple(bits[k] for k in ("often", "grow", "decide")))
    counted = rows.mapInArrow(released(_triples(sent)), "u1 long, u2 long, u3 long, c long").groupBy("u1", "u2", "u3").agg(F.sum("c").alias("a")).filter(F.col("a") >= least)
    triples = scratch.save(counted)
    front = known.select("u1", "u2", "lang", "bar", F.col("a").alias("front"), F.col("l").alias("one"))
    back = known.select(F.col("u1").alias("u2"), F.col("u2").alias("u3"), F.col("a").alias("back"), F.col("r").alias("three"))
    whole = triples.join(front, ["u1", "u2"]).join(back, ["u2", "u3"])
    whole = whole.withColumn("s1", _score("a", "one", "back")).withColumn("s2", _score("a", "front", "three"))
    cut = F.col("s1") <= F.col("s2")
    longer = whole.select("lang", "bar", "u1", "u2", "u3", "a", F.when(cut, F.col("one")).otherwise(F.col("front")).alias("l"),
                          F.when(cut, F.col("back")).otherwise(F.col("three")).alias("r"), F.least("s1", "s2").alias("score"))
    inside = triples.select("u1", "u2", "a").union(triples.select("u2", "u3", "a")).groupBy("u1", "u2").agg(F.max("a").alias("around"))
    alone = known.filter("score >= bar").join(inside, ["u1", "u2"], "left").filter(F.coalesce(100 * F.col("around") < cover * F.col("a"), F.lit(True)))
    both = longer.unionByName(alone.select("lang", "bar", "u1", "u2", F.lit(None).cast("long").alias("u3"), "a", "l", "r", "score"))
    out = scratch.save(both.filter("score >= bar"))
    scratch.drop(known, triples)
    return out


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", first: int = 2000, least: int = 10, cover: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``first`` best phrases.

    ``least``: occurrences that make a phrase a candidate; ``cover``: percent of a phrase's
    occurrences that one longer phrase must have to take its place.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    with Scratch(spark, "phrases") as scratch:
        words = scratch.save(rows.mapInArrow(released(_words), "u long, lang string, word string, c long").groupBy("u").agg(
            F.min("lang").alias("lang"), F.min("word").alias("word"), F.sum("c").alias("c")))
        sizes = scratch.save(words.groupBy("lang").agg(F.sum("c").alias("n")))
        often = scratch.save(words.filter(F.col("c") >= least))
        total = sizes.agg(F.sum("n")).first()[0] or 0
        sent = spark.sparkContext.broadcast(_bitmaps(often, F.col("u"), often=F.lit(True))["often"])
        counted = rows.mapInArrow(released(_pairs(sent)), "u1 long, u2 long, c long").groupBy("u1", "u2").agg(F.sum("c").alias("a")).filter(F.col("a") >= least)
        pairs = _with_words(scratch.save(counted), often, total)
        pairs = scratch.save(pairs.withColumn("score", _score("a", "l", "r")).withColumn("bound", F.expr(_ratio(_big("a"), _big("l")))))
        left, settled = scratch.save(pairs.select("lang").distinct()), None
        for place in (*(b * first for b in BARS), None):
            bars = scratch.save(_bars(pairs, left, place))
            found = _expanded(rows, pairs, bars, least, cover, scratch)
            n = found.groupBy("lang").agg(F.count(F.lit(1)).alias("found"))
            done = scratch.save(bars.join(n, "lang", "left").select("lang", ((F.col("bar") == 0) | (F.coalesce("found", F.lit(0)) >= first)).alias("done")))
            best = _ahead(found.join(done.filter("done").select("lang"), "lang", "left_semi"), first)
            settled = best if settled is None else settled.unionByName(best)
            left = done.filter("NOT done")
            if left.isEmpty():
                break
        ranked = _named(scratch.save(settled), words, first, scratch).join(sizes, "lang")
        return scratch.save(ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), keep=True)


def _ahead(found: DataFrame, first: int) -> DataFrame:
    """Candidates as good as their language's last wanted one, by score and count, or better."""
    last = _first(found, first, F.col("score").desc(), F.col("a").desc()).groupBy("lang").agg(F.min(F.struct("score", "a")).alias("last"))
    return found.join(last, "lang").filter(F.struct("score", "a") >= F.col("last")).drop("last", "bar")


def _named(best: DataFrame, words: DataFrame, first: int, scratch: Scratch) -> DataFrame:
    """Ranked candidates with their words."""
    used = best.select(F.explode(F.array("u1", "u2", "u3")).alias("u")).filter("u IS NOT NULL").distinct()
    said = scratch.save(words.join(used, "u").select("u", "word"))
    for k in "123":
        best = best.join(said.select(F.col("u").alias(f"u{k}"), F.col("word").alias(f"w{k}")), f"u{k}", "left")
    best = best.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    return _first(best, first, F.col("score").desc(), F.col("a").desc(), F.col("phrase"))


#: The same phrases from the definition: all are counted and scored, then ranked.
ORACLE = r"""
WITH pieces AS (
    SELECT lang, piece, row_number() OVER () AS id
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents)
), words AS (
    SELECT lang, id, generate_subscripts(w, 1) AS i, unnest(w) AS w1
    FROM (SELECT lang, id, list_filter(string_split(translate(piece, chr(9), ' '), ' '), lambda x: x <> '') AS w FROM pieces)
), runs AS (
    SELECT lang, w1, lead(w1) OVER following AS w2, lead(w1, 2) OVER following AS w3 FROM words WINDOW following AS (PARTITION BY id ORDER BY i)
), one AS (
    SELECT lang, w1, count(*) AS f FROM runs GROUP BY ALL
), two AS (
    SELECT lang, w1, w2, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), three AS (
    SELECT lang, w1, w2, w3, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), totals AS (
    SELECT lang, sum(f) AS n FROM one GROUP BY lang
), cuts AS (
    SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, 1 AS k, x.f AS l, y.f AS r
    FROM two p JOIN one x USING (lang, w1) JOIN one y ON y.lang = p.lang AND y.w1 = p.w2
    UNION ALL
    SELECT p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, p.f, 1, x.f, y.f
    FROM three p JOIN one x USING (lang, w1) JOIN two y ON y.lang = p.lang AND y.w1 = p.w2 AND y.w2 = p.w3
    UNION ALL
    SELECT p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, p.f, 2, x.f, y.f
    FROM three p JOIN two x USING (lang, w1, w2) JOIN one y ON y.lang = p.lang AND y.w1 = p.w3
), candidates AS (
    SELECT lang, phrase, a, l, r, score
    FROM (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM cuts)
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), around AS (
    SELECT lang, phrase, max(f) AS f
    FROM (SELECT lang, w1 || ' ' || w2 AS phrase, f FROM three UNION ALL SELECT lang, w2 || ' ' || w3, f FROM three) GROUP BY ALL
), ranked AS (
    SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM candidates c LEFT JOIN around o USING (lang, phrase)
    WHERE o.f IS NULL OR 100 * o.f < 50 * a
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
