"""Packing documents into sequences along a space-filling curve (operator 2).

Every document becomes token ids (a byte-level BPE vocabulary of the
``tokenizers`` library) and an end id.  Its ids are counted into a hashed
vector, the vector is projected to ``DIMS`` dimensions, and the point gets its
place on a Hilbert curve.  The documents are range-sorted by that place, so
neighbours on the curve, documents of alike words, lie next to each other,
and each partition is cut into sequences in this order.

A sequence has ``length`` ids; the ids that are left at a partition's end are
cut into sequences whose lengths are powers of two, which need no padding.
Every id lies in exactly one piece.

Defined results: a null text is an empty one (only the end id); a null
document number is kept; equal documents are packed as often as they occur,
each with its own pieces; an empty table gives no rows; further columns are
ignored.  Many equal documents have the same place on the curve; a hash of
the document number divides them between partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_worker, parts, save, trim_memory, worker_cache

LENGTH, END_ID = 1024, 0
BUCKETS, DIMS, BITS, SEED = 1024, 3, 10, 7
SPACE = "\u0120"  # how byte-level vocabularies write a space
MEMO = 1_000_000  # pieces of text whose ids a worker keeps


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts as bytes of little-endian unsigned 16-bit numbers.

    The vocabulary's pattern never lets a token cross from a character that is
    not white space to a space or line end, so a text may be cut there and the
    pieces' ids are kept for the next text.  A word before a lone comma or
    full stop is a token run of its own.
    """

    def __init__(self, path: str, memo: int | None = None):
        import os
        import re
        import numpy as np
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids must fit in 16 bits")
        self.double = re.compile(r"\s\s")
        self.cut = re.compile(r"(?<=\S)(?=[ \n])")
        self.begins = np.zeros(1 << 16, bool)
        self.begins[[i for token, i in self.tokenizer.get_vocab().items() if token[:1] == SPACE]] = True
        self.marks = dict(zip(["\r.", "\r,"], self._whole([".", ","])))
        self.kept, self.old = dict(self.marks), {}
        self.memo = MEMO if memo is None else memo

    def forget(self) -> None:
        """Drop the ids of pieces."""
        self.kept, self.old = dict(self.marks), {}

    def pieces(self, text: str) -> list[str]:
        """The text's pieces: a word stands for itself after a space, one after a line end
        begins with it, and any other begins with a tab that is not part of it."""
        if self.double.search(text):
            return ["\t" + x for x in self.cut.split(text) if x]
        out: list[str] = []
        for k, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            if k:
                out.append("\n" + first)
            elif first:
                out.append("\t" + first)
            out += rest
        return out

    @staticmethod
    def _slices(ids: list[int], starts: list[int]) -> list[bytes]:
        import numpy as np
        raw = np.array(ids, "<u2").tobytes()
        cuts = [2 * x for x in starts] + [len(raw)]
        return [raw[x:y] for x, y in zip(cuts, cuts[1:])]

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as they stand."""
        import numpy as np
        e = self.tokenizer.encode(texts, is_pretokenized=True, add_special_tokens=False)
        return self._slices(e.ids, np.searchsorted(np.array(e.word_ids, np.int64), np.arange(len(texts))).tolist())

    def _spaced(self, words: list[str]) -> list[bytes]:
        """Ids of words after a space, as one text: only a word's first token holds the space."""
        import numpy as np
        e = self.tokenizer.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0]
        return self._slices(e.ids, np.flatnonzero(self.begins[e.ids]).tolist())

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of ASCII letters after a space: one run of the pattern, so its merges alone decide."""
        ids: list[int] = []
        starts = []
        for x in words:
            starts.append(len(ids))
            ids += [t.id for t in self.tokenizer.model.tokenize(SPACE + x)]
        return self._slices(ids, starts)

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        made: dict[str, bytes] = {}
        letters, spaced, whole = [], [], []
        for x in pieces:
            (letters if x.isascii() and x.isalpha() else spaced if x and x[0] not in "\t\n" else whole).append(x)
        for some, ids in ((letters, self._letters), (spaced, self._spaced)):
            for a in range(0, len(some), 200):
                made.update(zip(some[a:a + 200], ids(some[a:a + 200]), strict=True))
        for a in range(0, len(whole), 200):
            texts = [x[1:] if x[:1] == "\t" else x or " " for x in whole[a:a + 200]]
            made.update(zip(whole[a:a + 200], self._whole(texts), strict=True))
        return made

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for a in range(0, len(texts), 128):
            cut = [self.pieces(t) for t in texts[a:a + 128]]
            if len(self.kept) > self.memo // 2:  # what was not used since the last time goes
                self.old, self.kept = self.kept, dict(self.marks)
            new = set().union(*cut).difference(self.kept)
            again = {x for x in new if x in self.old}
            self.kept.update((x, self.old[x]) for x in again)
            new -= again
            # a Latin word and the mark after it
            marked = {x for x in new if x[-1:] in (".", ",") and x[:-1].isalpha() and max(x) < "\u0250"}
            self.kept.update(self._new(list((new - marked) | {x[:-1] for x in marked if x[:-1] not in self.kept})))
            self.kept.update((x, self.kept[x[:-1]] + self.marks["\r" + x[-1]]) for x in marked)
            for c in cut:
                yield b"".join(map(self.kept.__getitem__, c))


def hilbert(points, bits: int = BITS):
    """Place of each row of ``points`` (whole numbers below 2**bits) on a Hilbert curve.

    The points' bits are turned into the curve's transposed place (undo excess
    work from the highest bit, then Gray-code) and interleaved.
    """
    import numpy as np
    x = np.array(points, np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def tokenized(docs: DataFrame, path: str, buckets: int = BUCKETS, dims: int = DIMS, bits: int = BITS,
              memo: int | None = None) -> DataFrame:
    """doc_id, ids (16-bit numbers as bytes, end id included), place on the curve.

    ``memo``: pieces of text whose ids a worker keeps, here to the end of a task only, as workers that idle
    keep theirs too (less memory, more time, the same ids).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import math
        import numpy as np
        encoder = worker_cache().get(("encoder", path, memo))
        if encoder is None:
            worker_cache().clear()
            trim_memory()  # also what tasks of other operators left behind
            encoder = worker_cache()[("encoder", path, memo)] = Encoder(path, memo)
        rng = np.random.default_rng(SEED)
        bucket = rng.integers(0, buckets, 1 << 16)
        project = rng.standard_normal((buckets, dims))
        end = np.array([END_ID], "<u2").tobytes()
        half = np.vectorize(math.erf, otypes=[float])
        for b in batches:
            for a in range(0, b.num_rows, 500):
                some = b.slice(a, 500)
                texts = [x or "" for x in some.columns[1].to_pylist()]
                ids, points = [], np.zeros((len(texts), dims))
                for i, x in enumerate(encoder.encode(texts)):
                    ids.append(x + end)
                    v = np.log1p(np.bincount(bucket[np.frombuffer(x, "<u2")], minlength=buckets))
                    points[i] = v @ project / max(np.sqrt(v @ v), 1e-9)
                cell = np.clip((half(points / math.sqrt(2)) + 1) / 2 * (1 << bits), 0, (1 << bits) - 1)
                yield pa.RecordBatch.from_arrays(
                    [some.columns[0], pa.array(ids, pa.binary()), pa.array(hilbert(cell.astype(np.int64), bits))],
                    names=["doc_id", "ids", "place"])
        if memo is not None:
            encoder.forget()
            trim_memory()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, place long")


def pack(rows: DataFrame, deal: list[Column], order: list[Column], length: int = LENGTH, partitions: int | None = None) -> DataFrame:
    """Cut documents (doc_id, ids), dealt out by range of ``deal`` and in ``order``, into sequences; a row a piece."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        import numpy as np
        from pyspark import TaskContext
        free_worker()  # the encoder of the stage before and what it keeps
        sequence = TaskContext.get().partitionId() << 40
        held: list[tuple] = []  # pieces (doc_id, start, ids, doc_tokens) of the sequence that is not full
        filled = 0
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

        def emit(pieces: list[tuple]) -> list[tuple]:
            out, at = [], 0
            for doc, start, ids, total in pieces:
                n = len(ids)
                out.append((doc, start, n, zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, at))
                at += n
            return out

        def table(cells: list[tuple], doc_type: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*cells))
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], doc_type), *[pa.array(c, pa.int64()) for c in cols[1:]]], names=names)

        doc_type = None
        for b in batches:
            doc_type = b.schema.field("doc_id").type
            made: list[tuple] = []
            for doc, raw in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.frombuffer(raw.as_buffer(), "<u2")
                start = 0
                while start < len(ids):
                    n = min(length - filled, len(ids) - start)
                    held.append((doc, start, ids[start:start + n], len(ids)))
                    start, filled = start + n, filled + n
                    if filled == length:
                        made += emit(held)
                        sequence, held, filled = sequence + 1, [], 0
                if len(made) > 20_000:
                    yield table(made, doc_type)
                    made = []
            if made:
                yield table(made, doc_type)
        while filled:  # the rest, in powers of two from the largest
            size = 1 << (filled.bit_length() - 1)
            part, room = [], size
            while room:
                doc, start, ids, total = held.pop(0)
                if len(ids) > room:
                    held.insert(0, (doc, start + room, ids[room:], total))
                    ids = ids[:room]
                part.append((doc, start, ids, total))
                room -= len(ids)
            yield table(emit(part), doc_type)
            sequence, filled = sequence + 1, filled - size

    n = partitions or parts(rows)
    dealt = rows.repartitionByRange(n, *deal).sortWithinPartitions(*order)
    return dealt.select("doc_id", "ids").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH,
                   partitions: int | None = None, memo: int | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    rows = save(tokenized(docs, path or tokenizer_path(), memo=memo), "packing-ids")  # texts are encoded once
    deal = [F.col("place"), F.xxhash64("doc_id")]
    return pack(rows, deal, [*deal, F.col("doc_id"), F.col("ids")], length, partitions)


__all__ = ["Encoder", "hilbert", "pack", "pack_documents", "tokenized", "tokenizer_path"]
