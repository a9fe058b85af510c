"""Token ids in a binary format, coded by a static range asymmetric numeral system.

Documents are sorted by doc_id over range partitions. Each task cuts its part
into files of about ``FILE_TOKENS`` ids (a document is never split over files).
A file holds one frequency table, counted over all its ids and shared by its
blocks; blocks of ``BLOCK_TOKENS`` ids, each coded by up to ``LANES``
interleaved coders and decodable alone; and an index that has, as a checkpoint
for each block, its place, its ids, its coders and a checksum. The document
table has the id and length of each document.

Layout, little-endian: magic ``HOPRANS1``; 8 bytes length of the JSON header;
JSON header (bits, n_tokens, n_docs, blocks: [offset, words, lanes, tokens,
crc32], sizes of the parts); zlib-packed table (symbols uint32, frequencies
uint32); zlib-packed documents (has_id uint8, doc_id int64, n_tokens uint32);
the blocks: lane states uint64, then words uint32. ``crc32`` covers a block's
bytes, ``head_crc32`` the table and the documents.

Files go to the shared folder under names of their own for each attempt; a
table of the committed attempts' files, written by Spark, says which count, so
a lost executor's leftovers are never read.

Defined results: a null text counts as empty and holds the end id alone; rows
sort by (doc_id, hash of the text, text), null ids first, so ties and repeated
rows have one order; an empty table gives no files and no rows; other columns
are ignored.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hopscope.llm.arrow_words import pieces
from hopscope.llm.common import BATCH_ROWS, SMALL_BATCHES, fresh_path, give_back, lean
from hopscope.plans.session import scoped_conf

MAGIC = b"HOPRANS1"
END_ID = 2
LANES = 1024
BLOCK_TOKENS = 1 << 18
FILE_TOKENS = 1 << 22
LOW = 1 << 31  # a coder's state stays in [2^31, 2^63)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols, their frequencies scaled to a sum of 2^bits (each at least 1), bits."""
    symbols, counts = np.unique(ids, return_counts=True)
    bits = max(12, int(len(symbols)).bit_length() + 2)
    scaled = np.maximum(1, (counts * ((1 << bits) / counts.sum())).astype(np.int64))
    order = np.argsort(-scaled, kind="stable")
    spare = (1 << bits) - int(scaled.sum())
    if spare > 0:
        scaled[order[0]] += spare
    while spare < 0:  # rounding up the rare ones took too much: take it back from the frequent ones
        cut = np.minimum(scaled[order] - 1, max(1, -spare // 64))
        cut = np.where(np.cumsum(cut) <= -spare, cut, 0)
        if not cut.any():
            cut[0] = 1
        scaled[order] -= cut
        spare += int(cut.sum())
    return symbols.astype(np.uint32), scaled.astype(np.uint32), bits


def encode_block(slots: np.ndarray, freq: np.ndarray, start: np.ndarray, bits: int, lanes: int) -> bytes:
    """``slots`` are places in the table. Lane i codes slots i, i + lanes, ..."""
    n = len(slots)
    f_all, c_all = freq[slots].astype(np.uint64), start[slots].astype(np.uint64)
    state = np.full(lanes, LOW, np.uint64)
    limit = np.uint64((LOW >> bits) << 32)
    words, b32, shift = [], np.uint64(32), np.uint64(bits)
    for lo in range((n - 1) // lanes * lanes, -1, -lanes):
        f, c = f_all[lo : lo + lanes], c_all[lo : lo + lanes]
        x = state[: len(f)]
        full = x >= limit * f
        if full.any():
            words.append(x[full].astype(np.uint32))
            x = np.where(full, x >> b32, x)
        q = x // f
        state[: len(f)] = (q << shift) + (x - q * f) + c
    return state.tobytes() + b"".join(w.tobytes() for w in reversed(words))


def decode_block(data: bytes, n: int, lanes: int, freq: np.ndarray, start: np.ndarray, slot_of: np.ndarray, bits: int) -> np.ndarray:
    state = np.frombuffer(data, np.uint64, lanes).copy()
    words = np.frombuffer(data, np.uint32, offset=8 * lanes).astype(np.uint64)
    out = np.empty(n, slot_of.dtype)
    at, mask, shift, b32, low = 0, np.uint64((1 << bits) - 1), np.uint64(bits), np.uint64(32), np.uint64(LOW)
    f64, c64 = freq.astype(np.uint64), start.astype(np.uint64)
    for lo in range(0, n, lanes):
        x = state[: min(lanes, n - lo)]
        low_bits = x & mask
        s = slot_of[low_bits]
        out[lo : lo + len(x)] = s
        x = f64[s] * (x >> shift) + low_bits - c64[s]
        short = np.flatnonzero(x < low)
        if len(short):
            x[short] = (x[short] << b32) | words[at : at + len(short)]
            at += len(short)
        state[: len(x)] = x
    if at != len(words) or (state != LOW).any():
        raise ValueError("a block doesn't end where it should")
    return out


def encode_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, block_tokens: int = BLOCK_TOKENS, max_lanes: int = LANES) -> bytes:
    symbols, freq, bits = frequencies(ids)
    start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint32)
    places = np.zeros(int(symbols[-1]) + 1 if len(symbols) else 1, np.uint32)
    places[symbols] = np.arange(len(symbols), dtype=np.uint32)
    slots = places[ids]
    blocks, body, at = [], [], 0
    for lo in range(0, len(ids), block_tokens):
        part = slots[lo : lo + block_tokens]
        lanes = int(min(max_lanes, max(1, len(part) // 64)))
        data = encode_block(part, freq, start, bits, lanes)
        blocks.append([at, len(data), lanes, len(part), zlib.crc32(data)])
        body.append(data)
        at += len(data)
    table = zlib.compress(symbols.tobytes() + freq.tobytes(), 6)
    has = np.array([d is not None for d in doc_ids], np.uint8)
    known = np.array([d or 0 for d in doc_ids], np.int64)
    docs = zlib.compress(has.tobytes() + known.tobytes() + np.array(lengths, np.uint32).tobytes(), 6)
    head = {"bits": bits, "n_symbols": len(symbols), "n_tokens": len(ids), "n_docs": len(doc_ids), "table": len(table), "docs": len(docs), "blocks": blocks, "head_crc32": zlib.crc32(table + docs)}
    packed = json.dumps(head).encode()
    return b"".join([MAGIC, len(packed).to_bytes(8, "little"), packed, table, docs, *body])


class Reader:
    """A file of the format: its document table, and any block by itself."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a file of this format")
        at = 16 + int.from_bytes(data[8:16], "little")
        self.head = h = json.loads(data[16:at])
        if zlib.crc32(data[at : at + h["table"] + h["docs"]]) != h["head_crc32"]:
            raise ValueError("checksum of table and documents differs")
        table = zlib.decompress(data[at : at + h["table"]])
        docs = zlib.decompress(data[at + h["table"] : at + h["table"] + h["docs"]])
        n, m = h["n_symbols"], h["n_docs"]
        self.symbols, self.freq = np.frombuffer(table, np.uint32, n), np.frombuffer(table, np.uint32, n, 4 * n)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint32)
        self.slot_of = np.repeat(np.arange(n, dtype=np.uint32), self.freq)
        has, known = np.frombuffer(docs, np.uint8, m), np.frombuffer(docs, np.int64, m, m)
        self.doc_ids = [int(d) if ok else None for d, ok in zip(known, has, strict=True)]
        self.lengths = np.frombuffer(docs, np.uint32, m, 9 * m)
        self.data, self.body = data, at + h["table"] + h["docs"]

    def block(self, i: int) -> np.ndarray:
        """The ids of block i, which starts at id ``i * BLOCK_TOKENS`` of the file."""
        at, size, lanes, n, crc = self.head["blocks"][i]
        part = self.data[self.body + at : self.body + at + size]
        if zlib.crc32(part) != crc:
            raise ValueError(f"checksum of block {i} differs")
        return self.symbols[decode_block(part, n, lanes, self.freq, self.start, self.slot_of, self.head["bits"])]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """Each document's id and ids, holding a document and a block at a time."""
        block, have = 0, np.zeros(0, np.uint32)
        for doc, n in zip(self.doc_ids, self.lengths, strict=True):
            parts, got = [have], len(have)
            while got < n:
                parts.append(self.block(block))
                got += len(parts[-1])
                block += 1
            have = np.concatenate(parts)
            yield doc, have[:n]
            have = have[n:]


#: Letters and other characters of words that are parted here: those that no version of Unicode sees otherwise.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ωА-яЁё"
OTHERS = r"!-/:-@\[-`{-~«»¡¿–—‘’“”…"
PLAIN = rf" ?[0-9{LETTERS}{OTHERS}]+(?:\n\n?[0-9{LETTERS}{OTHERS}]+)*"
RUNS = rf"('(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[{OTHERS}]+|\n)"
#: End a run and, as a run of its own, a word; not in a plain word.
RUN_END, WORD_END = "\x01", "\x02"


class Tokens:
    """Ids of texts by the tokenizers library.

    A byte-level pre-tokenizer always parts a text at a single space between two
    characters that are not space. So texts are cut at spaces, an Arrow batch of
    them at a time; each distinct word is encoded once, with the space before it,
    and the ids of all words are then put together by their codes. Words of plain
    characters are parted as the pre-tokenizer's expression does, into contractions,
    runs of letters, digits and other characters, and line ends; the runs of all new
    words go through the tokenizer's model in one call. Other words are encoded by
    themselves. Texts with other white space beside a space or at an end of theirs or
    with one of the tokenizer's added tokens, and all texts if the pre-tokenizer is
    not of this kind, are encoded whole."""

    #: Words that stay known, and their bytes; the first to come are the most frequent.
    KEPT = 250_000
    KEPT_BYTES = 16 << 20
    #: New words that are encoded at once: what the tokenizer returns has some 100 bytes a token.
    LEARNED = 1 << 13
    #: Ids that are put together at once.
    GATHERED = 1 << 18

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # Texts that hold one of these are encoded whole; the tokenizer takes them out first.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.dtype = np.uint32 if self.tokenizer.get_vocab_size() > 1 << 16 else np.uint16
        kind = json.loads(self.tokenizer.pre_tokenizer.__getstate__()) if self.tokenizer.pre_tokenizer else {}
        # The same model behind runs that are parted already; their bytes stand as the byte-level alphabet's characters.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        moved = iter(range(256, 512))
        self.alphabet = np.array([b if b in plain else next(moved) for b in range(256)], "<u4")
        self.alphabet[ord(RUN_END)] = ord(" ")
        mark = self.model_ids(WORD_END)
        self.parts = self.tokenizer.normalizer is None and kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space") and len(mark) == 1
        self.mark = mark[:1]
        self.words = pa.array([], pa.string())  # each with the space before it, but for texts' first words
        self.flat, self.size = np.zeros(0, self.dtype), np.zeros(0, np.int64)  # their ids, and how many each has

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def model_ids(self, runs: str) -> np.ndarray:
        moved = self.alphabet[np.frombuffer(runs.encode(), np.uint8)].tobytes().decode("utf-32-le")
        return np.array(self.model.encode_batch_fast([moved], add_special_tokens=False)[0].ids, self.dtype)

    def plain_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain words, and how many each has."""
        runs = pc.replace_substring_regex(words, RUNS, r"\1" + RUN_END)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(runs)], runs), WORD_END + RUN_END)[0].as_py() + WORD_END
        told = self.model_ids(joined)
        ends = np.flatnonzero(told == self.mark)
        return told[told != self.mark], np.diff(ends, prepend=-1) - 1

    def learn(self, new: pa.Array) -> np.ndarray:
        """Keep the ids of words and return their places; -1 for those that only their text can tell."""
        plain = pc.match_substring_regex(new, rf"\A(?:{PLAIN})\z")
        is_plain = plain.to_numpy(zero_copy_only=False)
        lone = ~is_plain
        bare = [w.removeprefix(" ") for w in new.filter(pa.array(lone)).to_pylist()]
        lone[lone] = [bool(w) and not w[0].isspace() and not w[-1].isspace() for w in bare]
        alone, plain = new.filter(pa.array(lone)), new.filter(plain)
        place, known = np.full(len(new), -1), len(self.words)
        place[is_plain] = known + np.arange(len(plain))
        place[lone] = known + len(plain) + np.arange(len(alone))
        told = [self.plain_ids(plain[lo : lo + self.LEARNED]) for lo in range(0, len(plain), self.LEARNED)]
        more = [ids for lo in range(0, len(alone), self.LEARNED) for ids in self.ids(alone[lo : lo + self.LEARNED].to_pylist())]
        self.flat = np.concatenate([self.flat, *(ids for ids, _ in told), *more])
        self.size = np.concatenate([self.size, *(size for _, size in told), np.array([len(x) for x in more], np.int64)])
        self.words = pa.concat_arrays([self.words, plain, alone])
        return place

    def together(self, texts: pa.Array) -> list[bytes | None]:
        """The ids of each text from those of its words; None if it is to be encoded whole."""
        cut = pc.split_pattern(texts, " ")
        begin = cut.offsets.to_numpy()
        begin, flat = begin - begin[0], cut.flatten()
        held, first = flat.dictionary_encode(), flat.take(pa.array(begin[:-1])).dictionary_encode()
        words = pa.concat_arrays([pc.binary_join_element_wise(" ", held.dictionary, ""), first.dictionary])
        # A text's first word has no space before it and so a code of its own.
        codes = held.indices.to_numpy().copy()
        codes[begin[:-1]] = len(held.dictionary) + first.indices.to_numpy()
        at = pc.fill_null(pc.index_in(words, self.words), -1).to_numpy().astype(np.int64)
        new = at < 0
        at[new] = self.learn(words.filter(pa.array(new)))
        known = np.append(self.size, 0)  # the last for words without a place
        size, start = known[at], (np.cumsum(known) - known)[at]
        end = np.concatenate([[0], np.cumsum(size[codes])])
        out = np.empty(end[-1], self.dtype)
        steps = np.unique([*np.searchsorted(end, np.arange(0, end[-1], self.GATHERED)), len(codes)])
        for lo, hi in pairwise([0, *steps.tolist()]):
            some, to = codes[lo:hi], end[lo : hi + 1]
            place = np.arange(to[0], to[-1]) + np.repeat(start[some] - to[:-1], size[some])
            out[to[0] : to[-1]] = self.flat[place]
        whole = np.logical_or.reduceat((at < 0)[codes], begin[:-1]).tolist()
        ends = end[begin].tolist()
        return [None if w else out[lo:hi].tobytes() for w, lo, hi in zip(whole, ends[:-1], ends[1:], strict=True)]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """The ids of each text, as bytes of ``dtype``."""
        texts = texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        whole = np.full(len(texts), not self.parts)
        for a in self.added:
            whole |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        out: list[bytes | None] = [None] * len(texts)
        at = np.flatnonzero(~whole)
        if len(at):
            for i, ids in zip(at.tolist(), self.together(texts.take(pa.array(at)) if whole.any() else texts), strict=True):
                out[i] = ids
        for i in [i for i, x in enumerate(out) if x is None]:
            out[i] = self.ids([texts[i].as_py()])[0].tobytes()
        if len(self.words) > 1.25 * self.KEPT or self.words.nbytes > 1.25 * self.KEPT_BYTES:
            ends = np.cumsum(pc.binary_length(self.words[: self.KEPT]).to_numpy())
            kept = int(np.searchsorted(ends, self.KEPT_BYTES, "right"))
            self.words, self.size = self.words.take(pa.array(np.arange(kept))), self.size[:kept].copy()
            self.flat = self.flat[: self.size.sum()].copy()
        return out


@lru_cache(maxsize=1)
def tokens_of(path: str) -> Tokens:
    """One for each Python worker, which Spark uses for many tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Tokens(path)


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


#: Bytes of text whose new words are encoded together.
LEARNED_BYTES = 2 << 20
#: ``before``: ids in the part's earlier files.
MANIFEST = "part int, before long, path string, n_docs long, n_tokens long, n_bytes long"


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, file_tokens: int = FILE_TOKENS, partitions: int | None = None) -> DataFrame:
    """Write the documents' ids below ``path`` (a folder that all executors
    share) and return the table of files, whose order is that of part, before."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    ordered = docs.select("doc_id", text.alias("text"))
    # Rows of one id, or without id, are spread by their text, equal ones by a number of their own.
    ordered = ordered.withColumn("hash", F.xxhash64("text")).withColumn("number", F.xxhash64(F.monotonically_increasing_id()))
    by = [F.col("doc_id").asc_nulls_first(), F.col("hash").asc(), F.col("number").asc()]
    ordered = ordered.repartitionByRange(n, *by).sortWithinPartitions(*by).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = tokens_of(tokenizer), TaskContext.get().partitionId()
        end = tokens.dtype(end_id).tobytes()
        doc_ids, lengths, held, count, before = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal doc_ids, lengths, held, count, before
            data = encode_file(doc_ids, lengths, np.frombuffer(b"".join(held), tokens.dtype))
            files, folder = _open(path)
            files.create_dir(folder, recursive=True)
            name = f"{part:06d}-{before:015d}-{uuid.uuid4().hex}.rans"
            with files.open_output_stream(f"{folder}/{name}") as out:
                out.write(data)
            row = [[part], [before], [f"{path}/{name}"], [len(doc_ids)], [count], [len(data)]]
            doc_ids, lengths, held, count, before = [], [], [], 0, before + count
            types = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], MANIFEST.replace(",", "").split()[::2])

        for batch in batches:
            for few in pieces(batch, 1, LEARNED_BYTES):
                for doc, ids in zip(few.column(0).to_pylist(), tokens.encode(few.column(1)), strict=True):
                    held.append(ids + end)
                    doc_ids.append(doc)
                    lengths.append(len(held[-1]) // len(end))
                    count += lengths[-1]
                    if count >= file_tokens:
                        yield flush()
            give_back()
        if doc_ids:
            yield flush()

    with scoped_conf(spark, SMALL_BATCHES):
        ordered.mapInArrow(lean(run), MANIFEST).write.parquet(f"{path}/files")
    return spark.read.schema(MANIFEST).parquet(f"{path}/files")


DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_tokens(files: DataFrame) -> DataFrame:
    """A row for each document of the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of its ids as little-endian uint32)."""
    spark = files.sparkSession
    # Ids before each part: one number for each partition of the writer.
    before, total = {}, 0
    for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        before[r["part"]] = total
        total += r["n"]
    shared = spark.sparkContext.broadcast(before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, earlier, path in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                files, place = _open(path)
                with files.open_input_stream(place) as f:
                    reader = Reader(f.read())
                start, rows = shared.value[part] + earlier, []
                for doc, ids in reader.documents():
                    rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                cols = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = max(1, len(before))
    return files.select("part", "before", "path").repartition(tasks).mapInArrow(lean(run), DOCS)


def token_files(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the documents to the shared folder, and read them back."""
    spark: SparkSession = docs.sparkSession
    return read_tokens(write_tokens(docs, tokenizer, fresh_path(spark, "rans"), **options))
