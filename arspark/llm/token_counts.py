"""Token counts of document sections from one encoding of the whole document.

A document is encoded once. Its tokens have character spans; a section has a
character span; the interval join of the two gives every section its tokens. A
token that lies in two or more sections is allocated by ``rule``:

* ``"first"``: to the section that holds its first character;
* ``"last"``: to the section that holds its last character;
* ``"most"``: to the section that holds most of its characters, the earlier if tied.

So the counts of a document's sections sum to its token count, which isn't so
if sections are encoded apart. Sections are lines here: a line ends after its
line feed, and the last line may have none.

Defined results: a null or empty text has one empty section without tokens;
repeated rows and null ids give their rows as they come; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arspark.llm.common import released
from arspark.llm.text import as_bytes, blocks
from arspark.llm.tokens import byte_encoder

RULES = ("first", "last", "most")


def attribute(at: np.ndarray, cuts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary.

    ``at``: start of each token, with the total at the end; ``cuts``: start of
    each section, with the total at the end. Both in one unit.
    """
    head = np.searchsorted(cuts, at[:-1], "right") - 1
    tail = np.searchsorted(cuts, np.maximum(at[1:] - 1, at[:-1]), "right") - 1  # a part of a character has an empty span
    crosses = head != tail
    if rule == "first" or not crosses.any():
        return head, crosses
    if rule == "last":
        return tail, crosses
    own = head.copy()
    for t in np.flatnonzero(crosses):
        part = np.arange(head[t], tail[t] + 1)
        share = np.minimum(cuts[part + 1], at[t + 1]) - np.maximum(cuts[part], at[t])
        own[t] = part[np.argmax(share)]
    return own, crosses


def _count(vocabulary: str, pattern: str, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = byte_encoder(vocabulary, pattern)
        for batch in batches:
            raw, off = as_bytes(batch.column(1))
            for i, j in blocks(off, 1 << 20):
                cols: list[list[np.ndarray]] = [[] for _ in range(6)]
                for k in range(i, j):
                    own = raw[off[k]:off[k + 1]]
                    ids, at = enc.encode(own.tobytes().decode("utf-8"))
                    # a byte that continues a character starts none; spans are in characters
                    chars = np.zeros(len(own) + 1, dtype=np.int64)
                    np.cumsum((own & 0xC0) != 0x80, out=chars[1:])
                    cuts = np.flatnonzero(own == 10) + 1
                    cuts = np.unique(np.concatenate([[0], cuts, [len(own)]]))
                    if len(cuts) == 1:
                        cuts = np.array([0, 0])
                    n = len(cuts) - 1
                    # a token that starts inside a character counts from that character's first byte
                    start = chars[np.minimum(at[:-1] + 1, len(own))] - 1 if len(ids) else at[:0]
                    span = np.append(start, chars[-1])
                    held, crosses = attribute(span, chars[cuts], rule)
                    got = np.bincount(held, minlength=n) if len(ids) else np.zeros(n, np.int64)
                    over = np.bincount(held[crosses], minlength=n) if len(ids) else np.zeros(n, np.int64)
                    for c, v in zip(cols, (np.full(n, k), np.arange(n), chars[cuts[:-1]], chars[cuts[1:]], got, over)):
                        c.append(v)
                doc, *rest = (np.concatenate(c) for c in cols)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), *(pa.array(x.astype(np.int64)) for x in rest)],
                                                 ["id", "section", "start_char", "end_char", "n_tokens", "n_crossing"])
    return run


def section_tokens(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   rule: str = "first") -> DataFrame:
    """One row per line of each document: id, section, start_char, end_char, n_tokens, n_crossing.

    ``n_crossing`` counts the section's tokens that reach into another section.
    ``vocabulary``: a file of byte-level ranks that every executor can read;
    ``pattern``: its pre-tokenization pattern.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    fields = [T.StructField("id", docs.schema[id_col].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in ("section", "start_char", "end_char", "n_tokens", "n_crossing")]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(released(_count(vocabulary, pattern, rule)), T.StructType(fields)).withColumnRenamed("id", id_col)
