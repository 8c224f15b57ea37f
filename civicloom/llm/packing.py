"""Power-of-two packing: documents are cut into pieces of binary length, equal lengths share a bucket.

A document of n ids gives n // 4096 whole pieces and one piece for each set bit of the
rest, longest first.  Every piece fills a sequence of its own power-of-two length, so no
sequence crosses documents and nothing is padded; batches are drawn from one bucket.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from civicloom.llm.common import forget, once, slices

#: Texts of these characters only are cut to words here, as the vocabulary file's own
#: rules would cut them; any other text goes whole through the tokenizer.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-\xb1\xb4-\xb8\xba\xbb\xbf-\xff]*")
#: The vocabulary file's rule for words, and what it comes to on those characters in lower case.
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z0-9\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+")
#: Where ASCII punctuation follows a letter, one word ends and the next begins, whatever stands around.
JOINT = r"([a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff])([!-/:-@\[-`{-~])"
REMEMBERED = 400_000
REMEMBERED_CHARS = 48


class WordTokenizer:
    """Ids of whole texts, remembering the ids of words.

    ``word_end`` marks the last token of a word in the vocabulary, so that many unknown
    words can be encoded in one call and their ids told apart.
    """

    def __init__(self, definition: str, word_end: str = "</w>") -> None:
        import json
        import os

        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        self.tokenizer = Tokenizer.from_str(definition)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.last[number] = token.endswith(word_end)
        rules = json.loads(definition)
        cuts = [x["pattern"]["Regex"] for x in (rules.get("pre_tokenizer") or {}).get("pretokenizers", []) if x.get("type") == "Split"]
        names = [x["type"] for x in (rules.get("normalizer") or {}).get("normalizers", [])]
        self.known_rules = cuts == [RULE] and names == ["NFC", "Replace", "Lowercase"]
        # The same model for words that are cut and in lower case already.
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.words: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def learn(self, order: list[str]) -> dict[str, bytes]:
        """Ids of words that are not remembered yet."""
        found: dict[str, bytes] = {}
        parts = [order[at : at + 64] for at in range(0, len(order), 64)]
        for part, encoded in zip(parts, self.merger.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(encoded.ids, np.uint32)
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            if len(ends) == len(part):
                raw = ids.tobytes()
                found.update(zip(part, [raw[lo:hi] for lo, hi in zip([0, *ends], ends)]))
            else:
                found |= {word: self.whole(word) for word in part}
        return found

    def of_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of texts without whitespace, in lower case and of plain characters."""
        cut = {c: WORDS.findall(c) for c in chunks if not c.isalpha()}
        # The words of these chunks get a small table of their own; the large one is asked once for each.
        own = dict.fromkeys(chain(filter(str.isalpha, chunks), chain.from_iterable(cut.values())))
        own.update(zip(own, map(self.words.get, own)))
        found = self.learn([w for w, ids in own.items() if ids is None])
        own.update(found)
        if len(self.words) + len(found) > REMEMBERED:
            self.words.clear()
        self.words.update((w, ids) for w, ids in found.items() if len(w) <= REMEMBERED_CHARS)
        ids = own.__getitem__
        own.update([(c, b"".join(map(ids, words))) for c, words in cut.items()])
        return list(map(ids, chunks))

    def __call__(self, texts: list[str], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each text's followed by ``end``, and how many each has.

        No word crosses whitespace: Arrow parts words from the punctuation behind them, cuts
        at whitespace and tells the chunks apart, so that each different one is looked up once.
        """
        plain = np.array([self.known_rules and "<|" not in t and PLAIN.fullmatch(t) is not None for t in texts])
        lower = pa.array([t.lower() if p else "" for t, p in zip(texts, plain)], pa.string())
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, JOINT, r"\1 \2"))
        coded = split.values.dictionary_encode()
        units = self.of_chunks(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        # What follows the chunks of a text: the end, behind all the ids of a text that is not cut.
        last = len(units) + np.where(plain, 0, np.cumsum(~plain))
        units += [end, *(self.whole(t) + end for t, p in zip(texts, plain) if not p)]
        sizes = np.fromiter(map(len, units), np.int64, len(units)) // 4
        stops = split.offsets.to_numpy()[1:]
        order = np.insert(coded.indices.to_numpy(), stops, last)
        many = sizes[order]
        before = np.cumsum(many) - many
        first = (np.cumsum(sizes) - sizes)[order]
        ids = np.frombuffer(b"".join(units), np.uint32)[np.repeat(first - before, many) + np.arange(many.sum())]
        return ids, np.diff(before[stops + np.arange(len(texts))] + sizes[last], prepend=0)


def binary_lengths(n: int, limit: int) -> Iterator[int]:
    """n as pieces of at most ``limit``, a power of two, longest first."""
    yield from (limit for _ in range(n // limit))
    rest = n % limit
    while rest:
        top = 1 << (rest.bit_length() - 1)
        yield top
        rest -= top


def pack(docs: DataFrame, definition: str, limit: int = 4096, end_id: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, bucket.

    ``definition`` is the tokenizer file's content, the only broadcast.  A null or empty
    text gives the end id alone.  ``bucket`` is log2 of the length; a sequence id holds
    bucket, input partition and a counter, so ids of one bucket are neighbours.  Nothing
    is shuffled.  Repeated rows are packed as often as they come.
    """
    if limit & (limit - 1):
        raise ValueError("limit must be a power of two")
    shared, name = docs.sparkSession.sparkContext.broadcast(definition), hashlib.sha256(definition.encode()).hexdigest()
    end = array("I", [end_id]).tobytes()
    kind = docs.schema[id_column].dataType.simpleString()
    fields = f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, bucket int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(besides=name)
        tokenizer, part = once(name, lambda: WordTokenizer(shared.value)), TaskContext.get().partitionId()
        next_of = [0] * limit.bit_length()
        for batch in slices(batches, "text", 4 << 20):
            ids, totals = tokenizer([t or "" for t in batch.column(1).to_pylist()], end)
            cut = [list(binary_lengths(n, limit)) for n in totals.tolist()]
            lengths = np.fromiter(chain.from_iterable(cut), np.int64)
            rows = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
            stops = np.cumsum(lengths)
            buckets = np.frexp(lengths)[1].astype(np.int64) - 1
            sequences = buckets << 58 | part << 34
            for bucket in np.unique(buckets).tolist():
                at = np.flatnonzero(buckets == bucket)
                sequences[at] += next_of[bucket] + np.arange(len(at))
                next_of[bucket] += len(at)
            offsets = 4 * np.concatenate([[0], stops])
            pieces = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(stops - lengths - (np.cumsum(totals) - totals)[rows]),
                    pa.array(lengths),
                    pieces.cast(pa.binary()),
                    pa.array(totals[rows]),
                    pa.array(sequences),
                    pa.array(np.zeros(len(rows), np.int64)),
                    pa.array(buckets, pa.int32()),
                ],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "bucket"],
            )

    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    return narrow.mapInArrow(run, fields).withColumnRenamed("id", id_column)
