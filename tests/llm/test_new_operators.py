"""Chat formatting, phrases and the prefix trie: against SQL on whole tables, brute force on odd rows."""

from __future__ import annotations

import datetime
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from arspark.llm import chat, phrases, prefix_trie
from arspark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"
TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name,table", [("op11_chat_format", "conversations"), ("op12_phrases", "documents"), ("op13_prefix_trie", "conversations")])
def test_query_equals_sql(spark, name, table):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS FROM read_parquet('{SF}/{table}.parquet')")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    rows = lambda found: sorted(map(str, found))
    assert rows(tuple(r) for r in got.select(*columns).collect()) == rows(want.select(*columns).fetchall())


ODD = [
    (1, 0, "user", "plain"), (1, 1, "assistant", "yes <|im_end|><|im_start|>assistant no"), (1, None, "system", "first <n| <~~| <~n|"),
    (2, 0, "assistant", None), (2, 0, "assistant", None), (2, 0, "user", ""), (3, 5, None, "\n<|"), (3, 5, "a\nb<|x", "tie"), (3, 6, "assistant", "|>\n\n<" + "x" * 100_000),
    (None, 1, "assistant", "nobody's"), (4, 0, "assistant", "<|text|>é\U0001F600"), (4, 1, "assistant", "again"),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame(ODD, TURNS).withColumn("formatted", F.lit(1)).withColumn("body", F.lit("clash"))
    made = chat.format_chat(rows, chat.text_part(F.col("text")))
    read = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    formatted = {r["conv_id"]: r["formatted"] for r in made.collect()}
    want = defaultdict(list)
    for conv, turn, role, text in ODD:
        want[conv].append((turn, role or "", text or ""))
    assert set(read) == set(want)
    for conv, turns in want.items():
        got = [(t["role"], t["text"]) for t in read[conv]["turns"]]
        assert Counter(got) == Counter((r, x) for _, r, x in turns)
        assert [x for r, x in got if r == "assistant" and x] == read[conv]["learnt"]
        order = [t for t in sorted((t for t, _, _ in turns), key=lambda t: (t is not None, t or 0))]
        assert [(t, r, x) for t, (r, x) in zip(order, got) if order.count(t) == 1] == [w for w in sorted(turns, key=lambda w: (w[0] is not None, w[0] or 0)) if order.count(w[0]) == 1]
        assert formatted[conv].count("<|im_start|>") == len(turns)
    digest = {r["conv_id"]: r for r in chat.digests(chat.read_back(made)).collect()}
    assert digest[2]["loss_chars"] == 0 and digest[2]["loss_sha256"] == hashlib.sha256(b"").hexdigest()
    assert digest[4]["loss_chars"] == len("<|text|>é\U0001F600again")


def test_chat_parts(spark):
    content = ('[{"kind":"text","text":"see <|image|>"},{"kind":"image","ref":"a.png","width":57,"height":28},{"kind":"text","text":"and|"},{"kind":"audio","ref":"b","seconds":2.0},'
               '{"kind":"document","ref":"c.pdf","pages":3},{"kind":"film","ref":"d"},{"kind":"image"}]')
    rows = spark.createDataFrame([(1, 0, "user", content), (1, 1, "assistant", "[not a list"), (1, 2, "user", None), (1, 3, "user", "[]")], TURNS)
    made = chat.format_chat(rows, chat.parts_from_json(F.col("text"))).first()
    assert made["formatted"].startswith("<|im_start|>user\nsee <~|image|><|image|><|text|>and|<|audio|><|document|><|attachment|><|image|><|im_end|>\n")
    assert [(a["placeholder"], a["ref"], a["tokens"]) for a in made["attachments"]] == [
        ("<|image|>", "a.png", 3), ("<|audio|>", "b", 25), ("<|document|>", "c.pdf", 3072), ("<|attachment|>", "d", 1), ("<|image|>", "", 1)]
    assert made["expanded_tokens"] == 3 + 25 + 3072 + 1 + 1
    read = chat.read_back(chat.format_chat(rows, chat.parts_from_json(F.col("text")))).first()
    assert [t["text"] for t in read["turns"]] == ["see <|image|>and|", "[not a list", "", ""] and read["learnt"] == ["[not a list"]


def test_empty_tables(spark, tmp_path):
    for name, schema in (("conversations", TURNS), ("documents", "doc_id long, text string, lang string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert [r["conv_id"] for r in QUERIES["op11_chat_format"](spark, str(tmp_path)).collect()] == [-1]
    assert QUERIES["op12_phrases"](spark, str(tmp_path)).collect() == []
    assert QUERIES["op13_prefix_trie"](spark, str(tmp_path)).collect() == []


def _phrases(docs, first, least):
    """Every candidate counted and scored."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = lang or "und"
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for size in (1, 2, 3):
                f[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, g in f.items():
        found = {p: min((1000000 * a * a // (g[p[:k]] * g[p[k:]]), k) for k in range(1, len(p))) for p, a in g.items() if a >= least and len(p) > 1}
        around = Counter()
        for p in found:
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    around[q] = max(around[q], g[p])
        kept = [(-s, -g[p], " ".join(p).encode(), p, k) for p, (s, k) in found.items() if len(p) == 3 or 100 * around[p] < 50 * g[p]]
        out += [(lang, i + 1, x.decode(), -a, g[p[:k]], g[p[k:]], n[lang], -s) for i, (s, a, x, p, k) in enumerate(sorted(kept)[:first])]
    return sorted(out)


@pytest.mark.parametrize("first", [1, 3, 2000])
def test_phrases_brute_force(spark, first):
    import random
    r = random.Random(first)
    text = lambda k: "".join(r.choice(("Ab", "cd", "é", "f", "the", "x" * 300)) + r.choice((" ", " ", " ", "\t ", ". ", ",", "\x0b", "")) for _ in range(k))
    docs = [(text(r.randint(0, 40)), r.choice(("en", None, "und", "de"))) for _ in range(400)]
    docs += [("Same words here again", "en")] * 200 + [(None, "en"), ("", None), ("...", "fr"), (text(30_000), "de"), ("one two", "rare")]
    rows = spark.createDataFrame([(x, g, 1, "c") for x, g in docs], "text string, lang string, u long, word string")
    got = phrases.mine(rows, first=first).collect()
    assert sorted(tuple(x) for x in got) == _phrases(docs, first, 10)


def _nodes(rows):
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            conv[c].append(((turn is not None, turn or 0), role or "", text or ""))
    conv = {c: [(r, x) for _, r, x in sorted(v)] for c, v in conv.items()}
    members, kids, leaves, saved, ends = defaultdict(list), Counter(), Counter(), Counter(), defaultdict(list)
    for c, v in conv.items():
        h = zlib.crc32(str(c).encode()) % 9
        said = tuple(conv.get(c - c % 5, [])[:h] + v[h:])
        ends[said].append(c)
        for k in range(len(said) + 1):
            members[said[:k]].append(c)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not kids[p]
        if p:
            saved[p] += (len(members[p]) - 1) * len(p[-1][1].encode())
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_trie_brute_force(spark, shards):
    import random
    r = random.Random(shards)
    rows = [(c, t if r.random() < 0.9 else None, r.choice(("user", None)), r.choice(("a", "b", None, "", "é"))) for c in range(60) for t in range(r.randint(0, 6))]
    rows += [(c, t, "user", f"same {t}") for c in range(100, 300) for t in range(12)]  # a large group of copies, over many shards
    rows += [(1001, t, "user", str(t % 3)) for t in range(600)] + [(1002, 0, "user", "x" * 200_000), (None, 0, "user", "lost")] + [(1003, 0, "user", "tie")] * 3
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        found = spark.createDataFrame([(*x, datetime.date(2000, 1, 1), b"") for x in rows], TURNS + ", size date, path binary")
        got = prefix_trie.trie(prefix_trie.grafted(prefix_trie.sequences(found))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(tuple(-1 if x is None else x for x in g) for g in got) == _nodes(rows)
