"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Texts become token ids in one pass; only documents longer than a sequence are
cut. Full pieces are sequences already. The others are dealt by a hash into
blocks of about ``BLOCK`` pieces, and each block is packed on its own: longest
first, each piece into the open sequence with the least room that takes it. A
segment tree over the remaining capacities finds that one in a logarithmic
number of steps. A block wastes about one sequence at most, one in thousands.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenbasket.llm.tables import Scratch, ship_package
from evenbasket.llm.tokens import chunks

SEQUENCE = 4096
END_ID = 1
BLOCK = 16384
#: Words whose ids a task keeps, and bytes of text it takes at once.
KEPT_WORDS, TOKEN_CHUNK = 1_000_000, 2 << 20
VOCABULARY = "word_bpe_49k.json"


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, the others for letters from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class _Lookup(dict):
    """Values made once for each key."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


class WordTokenizer:
    """Token ids of texts, for a vocabulary whose tokens never cross white space.

    Ids of words are kept, up to a bound. Words of plain Latin letters go
    straight to the merges of the vocabulary, cut by its own pattern; any other
    word (combining marks, other scripts, special tokens' text) goes through
    the whole tokenizer, so the ids are the same as for the text at once.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        pattern = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.parts = regex.compile(pattern).findall
        #: No white space or controls beyond ASCII, no combining marks, no letter whose lower case is two.
        self.plain = regex.compile("[\x21-\x7e\xa1-\u012f\u0131-\u017f]*").fullmatch
        self.letters = _byte_letters()
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.words, self.pieces = _Lookup(self._word), _Lookup(self._piece)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.type).tobytes()

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        return self._packed([t.id for t in self.merges(spelled)])

    def _word(self, raw: bytes) -> bytes:
        word = raw.decode()
        if self.plain(word) is None or "<|" in word:
            return self._packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        word = word.lower()
        if word.isalpha():
            return self.pieces[word]
        return b"".join([self.pieces[x] for x in self.parts(word)])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        for known in (self.words, self.pieces):
            if len(known) > KEPT_WORDS:
                known.clear()
        look = self.words.__getitem__
        return [np.frombuffer(b"".join(map(look, text.split())), self.type).astype(np.uint32) for text in texts]


_tokenizers: dict[str, WordTokenizer] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False, path: Callable[[], str] = vocabulary_path) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32 (and ids). ``path`` gives the vocabulary's place on an executor."""
    ship_package(documents.sparkSession)
    source = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = path()
        tokenizer = _tokenizers.get(place) or _tokenizers.setdefault(place, WordTokenizer(place))
        for batch in batches:
            names, texts = batch.columns
            for row, to, data, offsets in chunks(texts, TOKEN_CHUNK):
                raw, cut = data.tobytes(), offsets.tolist()
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                for k, own in enumerate(tokenizer.encode([raw[a:b] for a, b in zip(cut, cut[1:], strict=False)])):
                    own = np.append(own, np.uint32(end_id))
                    for n, at in enumerate(range(0, len(own), sequence)):
                        part = own[at : at + sequence]
                        rows.append(row + k)
                        piece.append(n)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.astype("<u4").tobytes()))
                        if with_ids:
                            ids.append(part.astype(np.int32))
                columns = [names.take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return source.mapInArrow(run, schema)


class CapacityTree:
    """Segment tree over remaining capacities 0..size; a leaf counts the open bins with that room."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, bin) of the tightest open bin with at least ``need``, which is then not open any more."""
        count, node = self.count, need + self.leaves
        if not count[node]:
            # Up to the first subtree on the right that has a bin, then down its left edge.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not count[node]:
                    node += 1
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.bins[room].pop()


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each of the decreasing ``lengths``."""
    tree, bins, offsets, n = CapacityTree(capacity), [], [], 0
    for length in lengths:
        found = tree.take(length)
        if found is None:
            found, n = (capacity, n), n + 1
        room, number = found
        bins.append(number)
        offsets.append(capacity - room)
        if room > length:
            tree.put(room - length, number)
    return bins, offsets


def _pack_block(sequence: int):
    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "key"], ascending=[False, True], kind="stable")
        bins, offsets = best_fit(block["length"].tolist(), sequence)
        number = block["block"].iloc[0]
        return block.drop(columns=["block", "key"]).assign(sequence_id=np.array(bins, np.int64) + (int(number) << 32), offset=np.array(offsets, np.int64))

    return pack


def pack_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False, block: int = BLOCK, path: Callable[[], str] = vocabulary_path) -> DataFrame:
    """Pieces of all documents and their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A null or empty text is one piece that holds the end id alone. Rows that
    repeat a doc_id (or have none) are packed as documents of their own. An
    empty table has no pieces. Other columns are not read. sequence_id is any
    number; full pieces have negative ones.
    """
    scratch = Scratch(documents.sparkSession, "packing")
    pieces = scratch.keep(token_pieces(documents, doc_id, text, sequence, end_id, with_ids, path).withColumn("key", F.monotonically_increasing_id()))
    names = [c for c in pieces.columns if c != "key"]
    full = pieces.where(F.col("length") == sequence).select(*names, (-1 - F.col("key")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < sequence)
    blocks = max(1, math.ceil(rest.count() / block))
    dealt = rest.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema if f.name != "key") + ", sequence_id long, offset long"
    return full.unionByName(dealt.groupBy("block").applyInPandas(_pack_block(sequence), schema))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of a packing made ``with_ids``; a group is one sequence, bounded by its length."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
