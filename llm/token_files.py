"""Token ids in files of directly addressable codes.

Each id is cut into chunks of eight bits, lowest first. Level k holds the k-th chunk of every id that has one, and a bitmap of
the ids that go on to level k+1. A directory counts the set bits before each block of 512, so the place of any id on the next
level is one directory entry plus a count within one block: any token is read without decoding others.

A file is a Parquet part whose rows are segments, each a self-contained binary of some whole documents (their ids, lengths and
codes). Spark's own writer puts them wherever the session's file systems reach. Documents are in ascending order of doc_id
throughout: range-partitioned, sorted, and numbered by shard and segment.

Defined results: a null text counts as empty and has the end id alone. Documents without an id come first. Documents that
share an id follow one another in the order of their texts. Other columns are not read. No documents give no segments.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.common import ID, TEXT, pick, scratch

END_ID = 1
SEGMENT_TOKENS = 1 << 18  # a segment is closed by the document that reaches this
KEPT_WORDS, KEPT_FORMS = 600_000, 400_000  # words and forms of which a worker keeps the ids
BLOCK = 512
_HEAD = struct.Struct("<4sIIQ")  # mark, documents, levels, tokens
_MARK = b"DAC1"
_SEGMENT = "shard int, segment int, first_token long, tokens long, documents long, payload binary"


_TAIL = "!#$%&*+,-./:;=?@^_|~)]}"  # marks that make one piece wherever they stand together behind letters
_RISKY = re.compile("[\u03a3\u0130]")  # letters whose lower case depends on what stands beside them, or is two code points


class LibraryCoder:
    """The tokenizers library over the distinct words of a batch; ids of words met before are kept.

    Blanks and line feeds part words in any case, so the words of a text don't affect one another.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        tokens = self.library.get_vocab()
        self.ends = np.zeros(max(tokens.values()) + 1, bool)
        self.ends[[i for t, i in tokens.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {"": b""}  # in lower case, or marks: one piece each
        self.forms: dict[str, bytes] = {"": b""}  # as they stand in texts

    def _learn(self, new: list[str]) -> None:
        """Ids of words that are one piece each: a piece ends with the one token that says so."""
        groups = [new[i : i + 200] for i in range(0, len(new), 200)]
        for group, coded in zip(groups, self.library.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(coded.ids, dtype="<u4")
            raw, ends = ids.tobytes(), (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            self.words.update(zip(group, map(raw.__getitem__, map(slice, [0, *ends], ends)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes | None] = [None] * len(texts)
        split, odd = {}, []
        for k, text in enumerate(texts):
            # Lower case may come first where no other rule looks at letters before it does.
            if "<|" not in text and (text.isascii() or not _RISKY.search(text) and unicodedata.is_normalized("NFC", text)):
                split[k] = text.lower().replace("\n", " ").split(" ")
            else:
                odd.append(k)
        if len(self.forms) > KEPT_FORMS:
            self.forms = {"": b""}
        if len(self.words) > KEPT_WORDS:
            self.words = {"": b""}
        forms, words = self.forms, self.words
        parted, others, new = [], [], set()
        for form in set().union(*split.values()).difference(forms):
            body = form.rstrip(_TAIL)
            if body.isalpha():  # most forms: a word, with marks behind it
                if body not in words:
                    new.add(body)
                if body is not form:
                    tail = form[len(body) :]
                    if tail not in words:
                        new.add(tail)
                    parted.append((form, body, tail))
                else:
                    parted.append((form, form, ""))
            else:
                others.append(form)
        self._learn(list(new))
        for form, body, tail in parted:
            forms[form] = words[body] + words[tail] if tail else words[body]
        if others:
            for form, coded in zip(others, self.library.encode_batch_fast(others, add_special_tokens=False), strict=True):
                forms[form] = np.array(coded.ids, dtype="<u4").tobytes()
        if odd:
            for k, coded in zip(odd, self.library.encode_batch_fast([texts[k] for k in odd], add_special_tokens=False), strict=True):
                out[k] = np.array(coded.ids, dtype="<u4").tobytes()
        for k, text in split.items():
            out[k] = b"".join(map(forms.__getitem__, text))
        return out


_CODERS: dict[str, LibraryCoder] = {}


def coder(path: str) -> LibraryCoder:
    if path not in _CODERS:
        _CODERS[path] = LibraryCoder(path)
    return _CODERS[path]


def pack(ids: np.ndarray) -> list[bytes]:
    """Levels of chunks, bitmap and directory, three strings each."""
    out, rest = [], ids.astype("<u4")
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more.astype("<u4"), np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0, "<u4")
        before = np.concatenate([np.zeros(1, "<u4"), np.cumsum(ones)[:-1]]) if len(ones) else ones
        out += [rest.astype(np.uint8).tobytes(), bits.tobytes(), before.astype("<u4").tobytes()]
        if not more.any():
            return out
        rest = rest[more] >> 8


class Segment:
    """Some documents' ids; opened from, or written to, one binary."""

    def __init__(self, payload: bytes):
        mark, n_docs, n_levels, self.tokens = _HEAD.unpack_from(payload)
        if mark != _MARK:
            raise ValueError("not a segment of token ids")
        at = _HEAD.size
        self.has_id = np.frombuffer(payload, np.uint8, n_docs, at)
        self.doc_ids = np.frombuffer(payload, "<i8", n_docs, at := at + n_docs)
        self.lengths = np.frombuffer(payload, "<u4", n_docs, at := at + 8 * n_docs)
        sizes = np.frombuffer(payload, "<u4", 3 * n_levels, at := at + 4 * n_docs)
        at += 12 * n_levels
        self.levels = []
        for k in range(n_levels):
            parts = []
            for size, kind in zip(sizes[3 * k : 3 * k + 3], (np.uint8, np.uint8, "<u4"), strict=True):
                parts.append(np.frombuffer(payload, kind, int(size) // np.dtype(kind).itemsize, at))
                at += int(size)
            self.levels.append(parts)

    @staticmethod
    def write(docs: list[tuple[int | None, bytes]]) -> bytes:
        parts = pack(np.frombuffer(b"".join(ids for _, ids in docs), "<u4"))
        head = _HEAD.pack(_MARK, len(docs), len(parts) // 3, sum(len(ids) for _, ids in docs) // 4)
        return b"".join([
            head, np.array([i is not None for i, _ in docs], np.uint8).tobytes(),
            np.array([i or 0 for i, _ in docs], "<i8").tobytes(), np.array([len(x) // 4 for _, x in docs], "<u4").tobytes(),
            np.array([len(p) for p in parts], "<u4").tobytes(), *parts,
        ])

    def token(self, i: int) -> int:
        """The i-th id, by ranks alone."""
        value = 0
        for k, (chunks, bits, before) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * k
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            first = i // BLOCK * BLOCK
            within = np.unpackbits(bits[first >> 3 : (i >> 3) + 1], bitorder="little")[: i - first]
            i = int(before[i // BLOCK]) + int(within.sum())
        return value

    def all(self) -> np.ndarray:
        values = None
        for chunks, bits, _ in reversed(self.levels):
            here = chunks.astype("<u4")
            if values is not None:
                here[np.unpackbits(bits, count=len(here), bitorder="little").astype(bool)] |= values << 8
            values = here
        return values


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode and write. ``tokenizer``: path of the library's file on each machine; ``path``: folder that Spark can write."""

    def segments(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        use, shard = coder(tokenizer), TaskContext.get().partitionId()
        end = struct.pack("<I", end_id)
        held: list[tuple[int | None, bytes]] = []
        count, first, number = 0, 0, 0

        def close() -> pd.DataFrame:
            row = (shard, number, first, count, len(held), Segment.write(held))
            return pd.DataFrame([row], columns=["shard", "segment", "first_token", "tokens", "documents", "payload"])

        for part in parts:
            # few texts at a time, so that what is held doesn't depend on how many rows Spark sends
            for k in range(0, len(part), 256):
                some = part.iloc[k : k + 256]
                for known, doc, ids in zip(some["known"], some["doc"], use.encode(list(some["text"])), strict=True):
                    held.append((int(doc) if known else None, ids + end))
                    count += len(ids) // 4 + 1
                    if count >= segment_tokens:
                        yield close()
                        held, first, count, number = [], first + count, 0, number + 1
        if held:
            yield close()

    # The id is sent as two columns that are never null, so that pandas keeps all its 64 bits.
    sent = pick(docs, ID, TEXT).select(
        F.col(ID).isNotNull().alias("known"), F.coalesce(F.col(ID).cast("long"), F.lit(0)).alias("doc"), F.coalesce(TEXT, F.lit("")).alias("text")
    )
    ordered = sent.repartitionByRange("known", "doc").sortWithinPartitions("known", "doc", "text")
    ordered.mapInPandas(segments, _SEGMENT).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents in the files: doc_id, start (tokens before it in all files), n_tokens and token_ids (little-endian binary)."""
    files = spark.read.schema(_SEGMENT).parquet(path)
    # One row per shard: as many as there were partitions when the files were written.
    shards = files.groupBy("shard").agg(F.sum("tokens").alias("n"))
    base = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))

    def opened(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for first, payload in zip(part["first"], part["payload"], strict=True):
                s = Segment(payload)
                raw = s.all().tobytes()
                ends = np.cumsum(s.lengths.astype("i8"))
                starts = ends - s.lengths
                yield pd.DataFrame({
                    "doc_id": pd.array(np.where(s.has_id, s.doc_ids, 0), "Int64").copy() if s.has_id.all() else pd.array([int(d) if h else None for h, d in zip(s.has_id, s.doc_ids)], "Int64"),
                    "start": starts + first, "n_tokens": s.lengths.astype("i8"),
                    "token_ids": [raw[4 * a : 4 * b] for a, b in zip(starts, ends, strict=True)],
                })

    placed = files.join(F.broadcast(base), "shard").select((F.col("base") + F.col("first_token")).alias("first"), "payload")
    return placed.mapInPandas(opened, f"{ID} long, start long, n_tokens long, token_ids binary")


def file_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files, read them back, and digest what they hold per document."""
    path = scratch(docs.sparkSession, "token-files")
    write_token_files(docs, tokenizer, path)
    return read_token_files(docs.sparkSession, path).select(ID, "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))
