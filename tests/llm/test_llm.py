"""Operators against brute force, exact round trips and held-out accuracy, with odd rows: nulls, empty and long texts, copies, clashing columns."""

import base64
import collections
import hashlib
import inspect
import pathlib
import random
import re
import tempfile
import tracemalloc
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from arspark.llm import decontam, jaccard, langid, lm, packing, quality, subword, suffix_dedup, token_counts, vptree, warc
from arspark.llm.common import Scratch, crc_fold, table
from arspark.llm.queries import vocabulary_path
from arspark.llm.text import NOT_SPACE, Words, as_bytes
from tests.conftest import SF_SMALL

UP = {i: i + 32 for i in range(65, 91)}
ODD = "doc_id long, text string, n int, id int, key string"


@pytest.fixture(scope="module")
def odd(spark):
    """Random texts of few words with copies, near copies, shared passages and odd rows; extra columns that clash with inner names."""
    rng = random.Random(5)
    words = [f"W{k}" for k in range(60)] + ["été", "a.b", "x"]
    passage = [rng.choice(words) for _ in range(40)]
    rows = []
    for k in range(150):
        text = [rng.choice(words) for _ in range(rng.choice([0, 1, 3, 4, 5, 6, 20, 60, 200]))]
        if k % 4 == 0:
            text += passage[:rng.randint(10, 40)]
        if k % 3 == 0 and rows:
            text = (rows[-1][1] or "").split()
            for _ in range(rng.randint(0, 3)):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((k, " ".join(text)))
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "long " * 30000), (204, "y" * 5000), (5, rows[5][1]), (None, rows[7][1]), (None, "alone here")]
    return spark.createDataFrame([(*r, 1, 2, "k") for r in rows], ODD).repartition(4)


def empty(spark):
    return spark.createDataFrame([], ODD)


def test_near_duplicates(spark, odd):
    rows = odd.select("doc_id", "text").collect()
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(UP))
        sets.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                root[find(i)] = find(j)
    best = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            best[find(i)] = min(best.get(find(i), r.doc_id), r.doc_id)
    want = sorted((str(r.doc_id), len(s), str(best.get(find(i)) if s else r.doc_id)) for i, (r, s) in enumerate(zip(rows, sets)))
    got = sorted((str(r[0]), r[1], str(r[2])) for r in jaccard.near_duplicates(odd).collect())
    assert got == want
    assert jaccard.near_duplicates(empty(spark)).count() == 0


def test_near_duplicates_without_ids(spark):
    """Two documents that only a text without an id links; a near copy without an id; one without any partner."""
    import corpus_pipeline
    w = [f"a{k}" for k in range(100)]
    x = [f"b{k}" for k in range(100)]
    rows = [(1, w[13:]), (2, w[:87]), (None, w), (None, w), (5, x), (None, x[:95]), (None, [f"c{k}" for k in range(50)])]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in rows], "doc_id long, text string").repartition(3)
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect())
    assert got == {(1, 83, 1): 1, (2, 83, 1): 1, (None, 96, 1): 2, (5, 96, 5): 1, (None, 91, 5): 1, (None, 46, None): 1}
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 5]


def linked_groups(texts):
    """Smallest index that each text's links reach, by brute force; texts of five words or more."""
    sets = [frozenset(tuple(t[i:i + 5]) for i in range(len(t) - 4)) for t in texts]
    low = list(range(len(sets)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                a_root, b_root = sorted((find(i), find(j)))
                low[b_root] = a_root
    return [find(i) for i in range(len(sets))]


def altered(rng, n, size=120):
    """Copies of one text with words replaced, pieces cut off its end, passages that many share, and copies of altered copies."""
    words = [f"w{k}" for k in range(3000)]
    base = [rng.choice(words) for _ in range(size)]
    passage, out = [rng.choice(words) for _ in range(12)], [base]
    for k in range(n):
        t = list(base if k % 5 else rng.choice(out))
        for _ in range(rng.choice([0, 1, 3, 5, 6, 8])):
            t[rng.randrange(len(t))] = rng.choice(words)
        if k % 7 == 0:
            t = t[:rng.randint(60, len(t))] if len(t) > 60 else t
        if k % 6 == 0:
            t = t + passage
        if k % 11 == 0:
            t = base[10:rng.randint(80, size)]
        out.append(t)
    return out


@pytest.mark.parametrize("star, turns, whole", [(3, 1, True), (3, 2, True), (3, 3, False), (1 << 40, 2, True)])
def test_near_duplicates_in_crowded_stars(spark, monkeypatch, star, turns, whole):
    """Altered copies of two texts, with and without the original; every way of pairing gives the same groups."""
    monkeypatch.setattr(jaccard, "STAR", star)
    monkeypatch.setattr(jaccard, "TURNS", turns)
    rng = random.Random(star + turns)
    texts = altered(rng, 150)[0 if whole else 1:] + altered(rng, 60, 90)[1:]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert got == dict(enumerate(linked_groups(texts)))


def test_pairs_grow_with_the_copies(spark, monkeypatch):
    """Twice as many copies, too far from each other to link, don't bring four times the pairs."""
    seen, real = [], jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *a: seen.append(pairs.count()) or real(pairs, *a))
    rng = random.Random(1)
    base = [f"w{k}" for k in range(120)]
    for n in (150, 300):
        texts = [[w if rng.random() > 0.06 else f"n{rng.random()}" for w in base] for _ in range(n)]
        docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
        assert got == dict(enumerate(linked_groups(texts)))
    assert len(seen) == 4 and seen[1] <= 5 * 150 and seen[3] <= 5 * 300, seen


def test_entries_are_not_looked_up_one_by_one(spark, monkeypatch):
    """Crowded stars look up only rows of texts, however many prefix entries there are."""
    seen, real = [], jaccard.rows_with_ids
    monkeypatch.setattr(jaccard, "STAR", 3)
    monkeypatch.setattr(jaccard, "rows_with_ids", lambda rows, *a, **b: seen.append(rows.columns) or real(rows, *a, **b))
    texts = altered(random.Random(4), 80)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    assert got == dict(enumerate(linked_groups(texts)))
    assert len(seen) == 2 + jaccard.TURNS and all("text" in c for c in seen), seen


def test_levels_of_the_sketch_by_chunks(spark):
    """The levels equal those of all counters at once, and the driver never holds the unpacked counters."""
    rng = np.random.default_rng(3)
    parts = {k: rng.poisson(40, 1 << jaccard.CHUNK_BITS).astype(np.int32) for k in (0, 5, 255)}
    for p in parts.values():
        p[rng.integers(0, len(p), 9)] += 5000
    packed = [(k, zlib.compress(p.tobytes(), 1)) for k, p in parts.items() for _ in range(2)]
    profile = spark.createDataFrame([*packed, (None, None)], "chunk int, counts binary")
    whole = np.zeros((1 << (jaccard.SKETCH_BITS - jaccard.CHUNK_BITS), 1 << jaccard.CHUNK_BITS), dtype=np.int64)
    for k, p in parts.items():
        whole[k] = 2 * p.astype(np.int64)
    tracemalloc.start()
    got = jaccard._level(profile)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got, jaccard.levels_of(whole.ravel())) and got.any()
    assert most < whole.nbytes / 2, most


def test_prefixes_share_enough():
    """Two sets of the asked similarity share at least l entries of their l-prefixes, whatever the order."""
    rng = np.random.default_rng(2)
    level = rng.integers(0, 3, 1 << jaccard.SKETCH_BITS).astype(np.uint8)
    for _ in range(50):
        n = int(rng.integers(2, 80))
        both = rng.integers(0, 2**64, n, dtype=np.uint64)
        cut = int(n * 0.12)
        a, b = np.unique(both[cut:]), np.unique(both[:n - cut])
        if 100 * len(np.intersect1d(a, b)) < 75 * len(np.union1d(a, b)):
            continue
        vals, row, pos, own, _ = jaccard.prefixes(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), level, 75)
        least = -(-75 * (len(a) + len(b)) // 175)
        l = int(min(own[row == 0][0], own[row == 1][0]))
        inside = [set(vals[(row == k) & (pos < m - least + l)].tolist()) for k, m in enumerate((len(a), len(b)))]
        assert len(inside[0] & inside[1]) >= l


def test_decontamination(spark, odd):
    texts = [r.text for r in odd.collect() if r.doc_id is not None and r.doc_id < 150 and r.text]
    items = [(1, " ".join(texts[10].split()[:25])), (2, texts[20][:80]), (3, "w3 x"), (3, "w3 x"), (4, None), (5, " ..."), (6, "nowhere at all"), (7, max(texts, key=len))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP))
    want = []
    for r in odd.collect():
        w, hit, found = split(r.text), set(), set()
        for k, t in items:
            x = split(t)
            size = min(13, len(x))
            grams = {tuple(x[i:i + size]) for i in range(len(x) - size + 1)} if size else set()
            for i in range(len(w) - size + 1 if size else 0):
                if tuple(w[i:i + size]) in grams:
                    hit.update(range(i, i + size))
                    found.add(str(k))
        want.append((str(r.doc_id), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    for block in (2_000_000, 10):
        got = decontam.contamination(odd, bench, block_words=block).collect()
        assert sorted((str(r[0]), *r[1:6]) for r in got) == sorted(want)
    assert decontam.contamination(odd, bench.limit(0)).filter("contaminated").count() == 0
    assert decontam.contamination(empty(spark), bench).count() == 0


def test_language_and_quality(spark):
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    fold = crc_fold("doc_id", 3) == 1
    model = langid.train(docs, ~fold)
    got = langid.identify(docs, model, carry=("doc_id", "lang")).filter(fold)
    assert got.filter("lang = lang_pred").count() >= 0.95 * got.count()
    assert got.filter("score < 0 OR score > 1").count() == 0
    odd_rows = spark.createDataFrame([(1, None, "xx"), (2, "", None), (3, "12 + 3 !", None)], "doc_id long, text string, lang string")
    assert {tuple(r) for r in langid.identify(odd_rows, model).collect()} == {(k, "und", 0.0, True) for k in (1, 2, 3)}
    none = langid.train(odd_rows.filter("lang IS NULL"), F.lit(True))
    assert langid.identify(odd_rows, none).filter("lang_pred != 'und'").count() == 0
    found = quality.score(docs, quality.train(docs, labels.filter(crc_fold("doc_id", 4) != 2))).join(labels, "doc_id")
    assert found.filter("(score >= 0.7) = (quality = 1)").count() >= 0.85 * found.count()
    assert quality.score(odd_rows, quality.train(docs, labels.limit(0))).filter("score != 0.5").count() == 0


def test_examples_come_in_pieces(spark, monkeypatch):
    texts = [(k % 3, f"document {k} " + " ".join(f"w{k * 31 + i}x" for i in range(200))) for k in range(300)]
    df = spark.createDataFrame(texts, "label int, text string").repartition(8)
    raw = lambda t: (np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
    want = []
    for label, t in texts:
        kinds = [np.unique(h, return_counts=True) for h, _ in langid.SPACE.features(*raw(t), 0, 1)]
        total = [c.sum() for _, c in kinds]
        want.append((label, np.concatenate([u for u, _ in kinds]).astype(np.int32).tobytes(), np.concatenate([c / n for (_, c), n in zip(kinds, total)]).astype(np.float32).tobytes()))
    # rows that the driver's JVM is asked for at once
    at_once, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: at_once.append(out := collect(self)) or out)
    got = subword.examples(df, langid.SPACE)
    assert [(x[0], x[1].tobytes(), x[2].tobytes()) for x in got] == sorted(want, key=lambda r: (str(r[0]), r[1], r[2]))
    assert max(map(len, at_once), default=0) < len(texts) / 2


def test_lm(spark, odd):
    model = lm.fit(odd)
    got = lm.score(odd, model).collect()
    assert len(got) == odd.count() and all((r.n_words == 0) == (r.mean_log_prob is None) and r.log_prob <= 0 for r in got)
    # class probabilities of each place sum to one
    around = np.full((2 * lm.WINDOW, lm.CLASSES), 3)
    assert abs(np.exp(lm.log_probs(model[1], around, np.arange(lm.CLASSES))).sum() - 1) < 1e-4
    # natural text scores better than its words in random order
    text = " ".join(["alpha beta gamma delta"] * 300)
    mixed = text.split()
    random.Random(1).shuffle(mixed)
    two = spark.createDataFrame([(1, text), (2, " ".join(mixed))], "doc_id long, text string")
    score = {r.doc_id: r.log_prob for r in lm.score(two, lm.fit(spark.createDataFrame([(text,)] * 40, "text string"), stride=1, rate=0.1)).collect()}
    assert score[1] > score[2]
    assert lm.score(empty(spark), lm.fit(empty(spark))).count() == 0


def test_lm_counts_every_word(spark):
    """All words train the network, whatever their place; a rare word's probability follows its own count, not that of a frequent one."""
    texts = ["one two"] * 3 + ["the " * 30 + f"rare{k}" for k in range(40)] + ["rare0 rare1 " * 2]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    count = collections.Counter(w for t in texts for w in t.split())
    steps, step = [], lm.train_step
    lm.train_step = lambda weights, around, c, rate: steps.append(len(c))
    try:
        vocabulary, weights, _ = lm.fit(docs.limit(0))
        sent = types.SimpleNamespace(value=(vocabulary, weights))
        list(lm._train(sent, inspect.signature(lm.fit).parameters["stride"].default, 0.1)(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    finally:
        lm.train_step = step
    assert sum(steps) == sum(count.values())
    for top in (1, 7, lm.TOP):
        model = lm.fit(docs, top=top)
        assert (model[2] is None) == (top >= len(count))
        assert model[2] is None or {1: 1, 7: 5}[top] == len(count) - model[2].count()  # words as frequent as each other stay together
        words = spark.createDataFrame([(k, w) for k, w in enumerate([*count, "unseen"])], "doc_id long, text string")
        got = {r.text: r.log_prob for r in lm.score(words, model, carry=("text",)).collect()}
        hashed = {w: Words(*as_bytes(pa.array([w])), 0, 1, NOT_SPACE).hash for w in got}
        cls = {w: int(model[0].class_of(h)[0]) for w, h in hashed.items()}
        total = collections.Counter()
        for w, n in count.items():
            total[cls[w]] += n
        for w, p in got.items():
            c = np.array([cls[w]])
            share = 1 if c[0] < lm.OWN else count.get(w, 1) / (total[c[0]] + 1)
            assert abs(p - np.log(share) - lm.log_probs(model[1], np.full((2 * lm.WINDOW, 1), lm.CLASSES), c)[0]) < 1e-6
        # sums over documents agree with a model that has all counts at hand
        sums = {r.doc_id: (r.n_words, r.log_prob) for r in lm.score(docs, model).collect()}
        here = lm.Vocabulary(*(np.concatenate(x) for x in zip(*[(h, [count[w]]) for w, h in sorted(hashed.items(), key=lambda x: -count[x[0]]) if w in count])), np.zeros(lm.CLASSES))
        here.own, here.own_class, here.log_total = model[0].own, model[0].own_class, model[0].log_total
        for r in lm.score(docs, (here, model[1], None)).collect():
            assert sums[r.doc_id][0] == r.n_words and abs(sums[r.doc_id][1] - r.log_prob) < 1e-6


def test_warc(spark):
    evil = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(k, f"http://x/{k % 7} é", f"<p>page {k // 3}</p>\r\n") for k in range(40)] + [(50, None, None), (51, "", ""), (52, "a\r\nb", evil), (53, "u", "x" + evil * 3), (52, "a\r\nb", evil)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, off string").repartition(3)
    path = Scratch(spark, "test-warc").path()
    warc.write_archives(pages, path, records_per_file=5)
    got = sorted((r.record_id, r.type, r.refers_to or "", r.full_bytes, r.full_digest) for r in warc.resolved(warc.read_archives(spark, path)).collect())
    first = {}
    for k, _, html in rows:
        first[html or ""] = min(first.get(html or "", k), k)
    want = []
    for k, _, html in rows:
        b, f = (html or "").encode(), first[html or ""]
        want.append((f"<urn:page:{k}>", "response" if f == k else "revisit", "" if f == k else f"<urn:page:{f}>", len(b), base64.b32encode(hashlib.sha1(b).digest()).decode()))
    assert got == sorted(want)
    held = warc.read_archives(spark, path, with_payload=True).filter("type = 'response'").select("payload").collect()
    assert {bytes(r.payload).decode() for r in held} == set(first)


def test_warc_long_url_and_damage(spark):
    """A header of any length is read; records that a damaged file loses are not lost silently."""
    urls = {k: f"http://x/{k}" for k in range(20)} | {4: "http://x/" + " " * 30000 + "WARC/1.1", 7: "u" * 200000}
    pages = spark.createDataFrame([(k, u, f"<p>{k // 2}</p>") for k, u in urls.items()], "page_id long, url string, html string").coalesce(1)
    path = Scratch(spark, "test-warc").path()
    warc.write_archives(pages, path)
    got = warc.resolved(warc.read_archives(spark, path)).collect()
    assert {r.record_id: (r.uri, r.full_bytes) for r in got} == {f"<urn:page:{k}>": (u.replace(" ", "%20"), len(f"<p>{k // 2}</p>")) for k, u in urls.items()}
    # lines that look like records inside a header are read in one go
    many = b"WARC/1.1\r\n" + b"a:WARC/1.1\r\n" * 50000 + b"Content-Length: 0\r\n\r\n"
    assert len(list(warc._headers(many + many))) == 100002
    cut = pathlib.Path(tempfile.mkdtemp(prefix="arspark-test-"))
    data = max((p.read_bytes() for p in pathlib.Path(path.removeprefix("file:")).glob("*.txt")), key=len)
    (cut / "cut.txt").write_bytes(data[:-10])
    with pytest.raises(ValueError, match="cut.txt"):
        warc.read_archives(spark, str(cut))
    held = warc.read_archives(spark, str(cut), damaged=True).count()
    (cut / "cut.txt").write_bytes(data)
    assert warc.read_archives(spark, str(cut)).count() == held + 1


def test_nearest(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 6)).round(1)
    x[50:90] = x[50]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(1000, None), (1020, [0.0] * 6), (1040, [float("nan")] * 6), (1060, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1080, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vptree.nearest(df, F.col("id") % 20 == 0, k=20, shard_rows=200, block_rows=7).collect()
    s = np.einsum("qd,rd->qr", x[::20], x)
    want = {}
    for i, q in enumerate(range(0, 600, 20)):
        order = [c for c in np.lexsort((np.arange(600), -s[i])) if c != q][:20]
        want.update({(q, r + 1): (c, s[i, c]) for r, c in enumerate(order)})
    assert {(r.query_id, r["rank"]): r.id for r in got} == {k: v[0] for k, v in want.items()}
    assert all(abs(r.score - want[r.query_id, r["rank"]][1]) < 1e-12 for r in got)
    assert vptree.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_packing(spark, odd):
    from tokenizers import Tokenizer
    path = vocabulary_path("word_bpe_49k.json")
    full = Tokenizer.from_file(path)
    packed = packing.pack(odd, path, max_tokens=256, with_ids=True)
    got = packed.collect()
    want = []
    for r in odd.collect():
        ids = [*full.encode(r.text or "", add_special_tokens=False).ids, 1]
        want += [(str(r.doc_id), k, a, len(ids[a:a + 256]), zlib.crc32(np.array(ids[a:a + 256], "<u4").tobytes())) for k, a in enumerate(range(0, len(ids), 256))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    rooms = {}
    for r in got:
        rooms.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in rooms.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    # best fit decreasing, one piece at a time
    bins = []
    for n in sorted((r.length for r in got), reverse=True):
        fits = [k for k, room in enumerate(bins) if room >= n]
        if fits:
            bins[min(fits, key=lambda k: bins[k])] -= n
        else:
            bins.append(256 - n)
    assert len(rooms) == len(bins)
    assert sum(len(r.ids) for r in packing.sequences(packed).collect()) == sum(r.length for r in got)
    assert packing.pack(empty(spark), path).count() == 0


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, rule):
    import public_tokenizers
    from tokenizers import Tokenizer
    texts = [(1, "Line one\n\n  two\nthree é日本\r\n\nend"), (2, None), (3, ""), (4, "\n"), (5, "no end"), (6, "über\n" * 50)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = token_counts.section_tokens(df, vocabulary_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, rule=rule)
    full = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    by = {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    assert by == {k: len(full.encode(t or "", add_special_tokens=False).ids) for k, t in texts}
    for k, t in texts:
        spans = [(r.start_char, r.end_char) for r in got.filter(F.col("doc_id") == k).orderBy("section").collect()]
        assert [(t or "")[a:b] for a, b in spans] == ((t or "").split("\n") if not t else re.findall(r"[^\n]*\n|[^\n]+$", t))


def repeats_by_hand(texts, length):
    seen, out = {}, []
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] = seen.get(t[i:i + length], 0) + 1
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("most", [suffix_dedup.MOST, 5])
def test_repeats(spark, odd, most):
    rows = odd.filter("doc_id IS NULL OR doc_id != 203").select("doc_id", "text").collect()
    want = repeats_by_hand([(r.text or "").encode() for r in rows], 40)
    got = suffix_dedup.remove_repeats(odd.filter("doc_id IS NULL OR doc_id != 203"), length=40, most=most).collect()
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted((str(r.doc_id), *w) for r, w in zip(rows, want))
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0
