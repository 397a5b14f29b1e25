"""Exact encoding and decoding with merge-type piece vocabularies.

Such a vocabulary defines the ids of a text by merging: neighbours are joined
again and again, best score first and leftmost among equals. A sequence of
pieces is that result exactly if merging any two neighbours of it by themselves
gives back the two, since merges inside a pair can't tell what stands around it
as long as none crosses its edges. So no text has to be merged: the encoder takes
the longest piece at each place (all of them from one Aho-Corasick pass over the
reversed text), goes on while neighbours are compatible, and otherwise takes the
next shorter piece or goes back by one. A place from which nothing goes on is
marked in a bit field and not tried again; as pieces up to a place are unique,
that holds for whatever led there.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from evenbasket.llm.tables import derive_columns

VOCABULARY = "piece_bpe_32k.model"
#: Segments and pairs of pieces whose results a task keeps, and characters of a long text taken at once.
KEPT_SEGMENTS, KEPT_PAIRS, SECTION = 400_000, 1_000_000, 1 << 20
#: Classes of characters that part segments (the smallest are taken together).
MOST_CLASSES = 6
#: The mark that stands for a space in pieces.
SPACE = "▁"


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    """A replacement character for every byte that is no UTF-8."""
    return "�", error.start + 1


codecs.register_error("evenbasket-each-byte", _each_byte)


def _segment_pattern(pieces: list[str]) -> str:
    """Stretches that no piece begins in and ends outside of: a class of characters that stand next to each other in pieces, behind spaces if any."""
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):  # spaces are characters like others
        letters = re.escape("".join(sorted({c for p in pieces for c in p})))
        return f"[{letters}]+|."
    group: dict[str, str] = {}

    def head(c: str) -> str:
        while group.setdefault(c, c) != c:
            c = group[c]
        return c

    for own in {p.lstrip(SPACE) for p in pieces}:
        for a, b in zip(own[:1] + own, own, strict=False):
            group[head(a)] = head(b)
    classes: dict[str, list[str]] = {}
    for c in group:
        classes.setdefault(head(c), []).append(c)
    large = sorted(classes.values(), key=lambda x: (-len(x), min(x)))
    large = large[: MOST_CLASSES - 1] + [[c for x in large[MOST_CLASSES - 1 :] for c in x]]
    runs = "|".join(f"[{re.escape(''.join(sorted(x)))}]+" for x in large if x)
    return f"{SPACE}+(?:{runs})?|{runs}|." if runs else f"{SPACE}+|."


class Pieces:
    """The pieces of a vocabulary, and encoding by backtracking."""

    def __init__(self, scores: dict[str, float], byte_ids: dict[int, int], ids: dict[str, int], unknown: int, prefix: bool = True):
        """``scores`` and ``ids`` of the pieces that merges may make; ids of the byte pieces; the ``unknown`` id; whether a space is put before each text."""
        import ahocorasick

        self.scores, self.ids, self.byte_ids, self.unknown, self.prefix = scores, ids, byte_ids, unknown, prefix
        whole = {p for p in scores if self.merged(p) == [p]}  # merges never give the others
        self.shorter: dict[str, str] = {}
        for p in whole:
            if len(p) > 1:
                self.shorter[p] = next((p[:k] for k in range(len(p) - 1, 1, -1) if p[:k] in whole), p[0])
        self.backwards = ahocorasick.Automaton()
        for p in whole:
            if len(p) > 1:
                self.backwards.add_word(p[::-1], p)
        self.backwards.make_automaton()
        #: No merge crosses the edges of these segments.
        self.segments = re.compile(_segment_pattern([p for p in scores if len(p) > 1]), re.DOTALL)
        self.known: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str, edge: int = 0) -> list[str] | None:
        """The pieces of ``text`` by merging its characters; None as soon as a merge crosses ``edge``."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                break
            if edge:
                begin = sum(map(len, parts[:at]))
                if begin < edge < begin + len(parts[at]) + len(parts[at + 1]):
                    return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging gives ``a`` and ``b`` back when they stand together."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        fits = self.pairs[a, b] = self.merged(a + b, len(a)) is not None
        return fits

    def backtracked(self, text: str) -> list[str]:
        """The pieces of ``text``; a character without a piece stands for itself."""
        n = len(text)
        longest = array("H", bytes(2 * n))
        for end, piece in self.backwards.iter(text[::-1]):
            size = len(piece)
            if size > longest[n - 1 - end]:
                longest[n - 1 - end] = size
        failed = bytearray(n // 8 + 1)
        shorter, pairs = self.shorter.get, self.pairs
        out: list[str] = []
        at, last, piece = 0, None, text[: longest[0] or 1]
        while True:
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1:
                    if last is None:
                        break
                    fits = pairs.get((last, piece))
                    if fits or fits is None and self.compatible(last, piece):
                        break
                piece = shorter(piece)
            if piece is None:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
                last = out[-1] if out else None
            else:
                out.append(piece)
                at = end
                if at == n:
                    return out
                last, piece = piece, text[at : at + (longest[at] or 1)]

    def _segment(self, segment: str) -> bytes:
        if len(self.known) >= KEPT_SEGMENTS:
            self.known.clear()
        ids = []
        for piece in self.backtracked(segment):
            one = self.ids.get(piece)
            if one is not None:
                ids.append(one)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in piece.encode()]
            else:
                ids.append(self.unknown)
        made = np.array(ids, np.int32).tobytes()
        if len(segment) <= 64:
            self.known[segment] = made
        return made

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without begin or end."""
        if not text:
            return np.zeros(0, np.int32)
        text = SPACE * self.prefix + text.replace(" ", SPACE)
        known, out = self.known.get, []
        for section in self._sections(text):
            out.append(b"".join([known(s) or self._segment(s) for s in self.segments.findall(section)]))
        ids = np.frombuffer(b"".join(out), np.int32)
        if not self.byte_ids:  # neighbours without a piece are one
            ids = ids[np.append(True, (ids[1:] != self.unknown) | (ids[:-1] != self.unknown))]
        return ids

    def _sections(self, text: str) -> Iterator[str]:
        """Parts of a long text, cut where a segment begins."""
        at = 0
        while len(text) - at > SECTION:
            end = at
            for found in self.segments.finditer(text, at + SECTION):
                if found.start() > at + SECTION:
                    end = found.start()
                    break
            # The first match may begin inside a segment; the one after it doesn't.
            if end == at:
                break
            yield text[at:end]
            at = end
        yield text[at:]


class Decoder:
    """Texts of ids."""

    def __init__(self, pieces: list[str], byte_of: dict[int, int], silent: set[int], unknown: int, prefix: bool = True):
        self.bytes = [bytes([byte_of[k]]) if k in byte_of else b"" if k in silent else p.replace(SPACE, " ").encode() for k, p in enumerate(pieces)]
        self.bytes[unknown] = " ⁇ ".encode()  # how a character without a piece is shown
        self.silent, self.prefix = silent, prefix
        #: Ids whose first space is the one put before a text.
        self.spaced = {k for k, p in enumerate(pieces) if p.startswith(SPACE) and k not in byte_of and k not in silent}

    def decode(self, ids: np.ndarray) -> str:
        listed = ids.tolist()
        raw = b"".join(map(self.bytes.__getitem__, listed))
        if self.prefix:
            first = next((k for k in listed if k not in self.silent), None)
            if first in self.spaced:
                raw = raw[1:]
        return raw.decode("utf-8", "evenbasket-each-byte")


_loaded: dict[str, tuple[Pieces, Decoder]] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str) -> tuple[Pieces, Decoder]:
    """Encoder and decoder of a model file, read once a process. The library gives the pieces; it isn't asked to encode or decode texts."""
    if path not in _loaded:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(model.get_piece_size())
        pieces = [model.id_to_piece(k) for k in size]
        byte_of = {k: int(pieces[k][3:5], 16) for k in size if model.is_byte(k)}
        silent = {k for k in size if model.is_control(k)}
        normal = {pieces[k]: k for k in size if not (k in byte_of or k in silent or model.is_unknown(k) or model.is_unused(k))}
        scores = {p: model.get_score(k) for p, k in normal.items()}
        encoder = Pieces(scores, {b: k for k, b in byte_of.items()}, normal, model.unk_id())
        _loaded[path] = encoder, Decoder(pieces, byte_of, silent, model.unk_id())
    return _loaded[path]


def _encode(path: Callable[[], str]):
    encoder, decoder = load(path())

    def run(data: np.ndarray, offsets: np.ndarray) -> list:
        raw, cut = data.tobytes(), offsets.tolist()
        ids = [encoder.encode(raw[a:b].decode()) for a, b in zip(cut, cut[1:], strict=False)]
        ends = np.concatenate(([0], np.cumsum([len(x) for x in ids], dtype=np.int64))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))
        return [lists, pa.array([decoder.decode(x) for x in ids], pa.string())]

    return run


def encode_texts(documents: DataFrame, keep: list[str], text: str = "text", path: Callable[[], str] = vocabulary_path) -> DataFrame:
    """``keep`` columns, ids (array) of each whole text, and decoded, the text those ids stand for.

    ``path`` gives the model's place on an executor. A null or empty text has no
    ids and decodes to an empty text. Equal rows get equal results; an empty table
    gives no rows. A kept column with the name of a made one is left out. A long
    text is taken in sections; of a stretch without an edge between segments (as
    one without spaces) two bytes a character, a bit field and the pieces are held.
    """
    return derive_columns(documents, text, keep, "ids array<int>, decoded string", lambda: _encode(path))


def decode_ids(documents: DataFrame, keep: list[str], ids: str = "ids", path: Callable[[], str] = vocabulary_path) -> DataFrame:
    """``keep`` columns and decoded, the texts of an ids column; bytes that are no UTF-8 become replacement characters. Null or empty ids give an empty text."""
    from pyspark.sql import functions as F

    kept = [c for c in keep if c.lower() != "decoded"]
    source = documents.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{ids}`").cast("array<int>").alias("decoded"))
    out = kept + ["decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = load(path())
        for batch in batches:
            texts = [decoder.decode(np.array(x.as_py() or [], np.int64)) for x in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string())], names=out)

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + ["decoded string"])
    return source.mapInArrow(run, schema)
