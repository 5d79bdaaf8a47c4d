"""Token counts (6): overlapping chunks of huge documents, spliced where two encodings provably agree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from waymark.llm.arrowtext import sliced
from waymark.llm.runtime import prepared
from waymark.llm.tokens import Encoder, encoder

#: Characters from which a document is huge, of a chunk's own part, and of the first overlap.
HUGE, CHUNK, OVERLAP = 32_768, 16_384, 256
#: Tokens that must agree in both encodings on either side of a splice, where the overlap holds that many.
AGREE = 4
COLUMNS = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
BATCH = 6 << 20


def splice(left: tuple, right: tuple, shift: int, low: int, high: int) -> int | None:
    """The first character in (low, high) at which both encodings can be cut, or None.

    left and right are (ids, token starts, unit starts) of a text and of its part from character shift on. A cut must be
    the start of a unit in both, which no pattern of the vocabulary crosses; and the tokens around it that both know must be the same.
    """
    ids_a, at_a, cut_a = left
    ids_b, at_b, cut_b = right
    both = np.intersect1d(cut_a[(cut_a > low) & (cut_a < high)], cut_b + shift)
    for cut in both.tolist():
        i, j = np.searchsorted(at_a, cut), np.searchsorted(at_b, cut - shift)
        after = min(AGREE, len(ids_a) - i, len(ids_b) - j)
        before = min(AGREE, i, int(np.count_nonzero(at_b[:j] + shift >= cut_b[1] + shift)) if len(cut_b) > 1 else 0)
        same = np.array_equal(ids_a[i - before : i], ids_b[j - before : j]) and np.array_equal(at_a[i - before : i], at_b[j - before : j] + shift)
        # The last unit that the left chunk sees may be cut short: it agrees only in units that end inside.
        end = np.searchsorted(at_a, cut_a[-1]) if len(cut_a) else 0
        after = max(0, min(after, end - i))
        if same and np.array_equal(ids_a[i : i + after], ids_b[j : j + after]) and cut <= (cut_a[-1] if len(cut_a) else 0):
            return cut
    return None


def count_huge(encode: Encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, from chunks that overlap; an overlap without a common cut is doubled."""
    total, begin = 0, 0  # begin: the cut from which the next chunk's tokens count
    while True:
        own_end = begin + chunk
        if own_end >= len(text):
            return total + len(encode.spans(text[begin:])[0])
        wide = overlap
        while True:
            end = min(len(text), own_end + wide)
            here = encode.spans(text[begin:end])
            if end == len(text):
                return total + len(here[0])
            start = max(begin, own_end - wide)
            there = encode.spans(text[start : min(len(text), end + wide)])
            cut = splice(here, there, start - begin, own_end - wide - begin, end - begin)
            if cut is not None and cut > 0:
                total += int(np.searchsorted(here[1], cut))
                begin += cut
                break
            wide *= 2


def counted(batches: Iterator[pa.RecordBatch], vocabulary: str, limit: int, huge: int, chunk: int, overlap: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(vocabulary)
    for batch in sliced(batches, "text", BATCH):
        text = pc.fill_null(batch.column("text"), "")
        long_ones = np.flatnonzero(pc.greater_equal(pc.utf8_length(text), huge).to_numpy(zero_copy_only=False))
        n = encode.counts(pc.if_else(pc.greater_equal(pc.utf8_length(text), huge), pa.scalar("", text.type), text))
        for i in long_ones.tolist():
            n[i] = count_huge(encode, text[i].as_py(), chunk, overlap)
        size = pc.binary_length(text).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), size, pa.array(n), pa.array(n > limit)], names=[c.split()[0] for c in COLUMNS.split(", ")])


def count_tokens(documents: DataFrame, vocabulary: str, limit: int = 2048, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Tokens of every whole text as the tokenizers library gives them, without added special tokens.

    A document of huge or more characters is encoded in chunks that overlap; neighbours are spliced at a unit start that both
    encodings hold with the same tokens around it, and an overlap without one is widened, up to the whole text. One
    narrow pass, no shuffle.

    Null or empty text: 0 bytes, 0 tokens. A null doc_id stays null; repeated rows count each; other columns are ignored.
    """
    return prepared(documents).select("doc_id", "text").mapInArrow(lambda it: counted(it, vocabulary, limit, huge, chunk, overlap), COLUMNS)
