"""SentencePiece encoding and decoding, by backtracking over merge-type pieces.

A merge-type encoder starts from characters and joins, again and again, the adjacent
pair whose joined text is the piece of the best score, the leftmost of equals. Two
adjacent tokens are compatible if merging their joined text alone gives back exactly
these two. A sequence of tokens is the encoding of its text exactly if all its
neighbours are compatible: up to the first merge across a border, what happens inside
two neighbouring tokens happens in the same order alone as within the whole text, so
that merge would happen to the two alone as well. This holds for any scores.

So a text is encoded from left to right without a queue of merges. Aho-Corasick gives
the longest piece that begins at each place. A piece is taken if it is compatible with
the one before it (the first one, if merging gives it back alone); otherwise the next shorter piece that begins there is tried. Where
none is left, the place is marked as failed in a bitfield and the token before it is
taken back. The tokens up to a place are the one encoding of the text before it, so a
failed place is never entered again and the work is linear.

Nothing is merged across two characters that no piece has side by side, such as a word and
the white space after it, so texts are cut there, the parts are independent, and a worker
keeps those it has seen, in a bounded cache. Characters without a piece become the pieces
of their bytes.

Edge cases: null and empty texts have no tokens and decode to the empty text; repeated
rows, null ids and other columns are passed over; long unsplit texts take time and
memory in proportion to their length. Models with user-defined or unused pieces, or of
another type than merges, are refused with a ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as proto

from rowsmith.llm._io import small_batches

#: Words that one worker keeps, in two generations of this size, and pairs; longer words aren't kept.
CACHE = 1 << 19
CACHED_CHARS = 64
#: The sign that stands for a space within pieces.
SPACE = "▁"


class PieceEncoder:
    """Encodes and decodes like ``SentencePieceProcessor(model_file=path)`` without begin and end ids.

    Within the encoder a token is a number: a piece's id, or a number above them for a character without a piece."""

    def __init__(self, path: str):
        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = proto.ModelProto.SentencePiece
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("only merge-type models without user-defined and unused pieces")
        self.normalise = SentencePieceProcessor(model_file=path).normalize
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE} if model.trainer_spec.byte_fallback else {}
        self.bytes = {i: b for b, i in self.byte_ids.items()}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)
        self.unknown_surface = model.trainer_spec.unk_surface
        self.strips = (model.normalizer_spec.add_dummy_prefix, model.normalizer_spec.remove_extra_whitespaces)
        self._index([(p.piece, p.score) if p.type == kinds.NORMAL else None for p in model.pieces])

    def _index(self, pieces: list[tuple[str, float] | None]) -> None:
        """What looking up and checking tokens takes; ``pieces`` by id, None for those that no text is made of."""
        self.score = {p[0]: p[1] for p in pieces if p}
        self.id = {p[0]: i for i, p in enumerate(pieces) if p}
        #: By token: its text, length, ids as written, and the text it decodes to.
        self.piece = [p[0] if p else "" for p in pieces]
        self.size = [len(p) for p in self.piece]
        self.names = [str(i) for i in range(len(pieces))]
        self.surface = [p.replace(SPACE, " ") for p in self.piece]
        self.characters: dict[str, int] = {}
        #: By token: the longest shorter token that begins like it, -1 below single characters.
        self.shorter = [next((self.id[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id), self._character(p[0]) if len(p) > 1 else -1) for p in list(self.piece)]
        self.shorter += [-1] * len(self.characters)
        self.trie = ahocorasick.Automaton()
        for i, p in enumerate(pieces):
            if p:
                self.trie.add_word(p[0], i)
        self.trie.make_automaton()
        #: Characters by their number, those in no piece sharing the last one; and whether two may stand apart: no piece has them side by side.
        signs = {c: i for i, c in enumerate(sorted(set("".join(self.score))))}
        self.kinds = len(signs) + 1
        self.sign = np.full(0x110000, len(signs), np.int32)
        self.sign[[ord(c) for c in signs]] = list(signs.values())
        self.apart = np.ones(self.kinds * self.kinds, bool)
        self.apart[[signs[x] * self.kinds + signs[y] for p in self.score for x, y in zip(p, p[1:], strict=False)]] = False
        self.fits: dict[int, dict[int, bool]] = {}
        self.pairs = 0
        self.words: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}

    def _character(self, sign: str) -> int:
        """The token of a single character, made up if it has no piece."""
        known = self.id.get(sign, self.characters.get(sign))
        if known is None:
            known = self.characters[sign] = len(self.piece)
            ids = [self.byte_ids[b] for b in sign.encode()] if getattr(self, "byte_ids", None) else [getattr(self, "unknown", -1)]
            self.piece.append(sign)
            self.size.append(1)
            self.names.append(",".join(map(str, ids)))
            self.surface.append(self.decode(ids, begins=False) if ids != [-1] else sign)
            if hasattr(self, "shorter"):
                self.shorter.append(-1)
        return known

    def merged(self, text: str) -> list[str]:
        """The tokens of a short text by merging: the best-scored adjacent pair first, the leftmost of equals."""
        parts = list(text)
        score = self.score.get
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                s = score(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a (none if below 0) and b stay as they are when their joined text is merged."""
        if self.pairs >= CACHE:
            for known in self.fits.values():
                known.clear()
            self.pairs = 0
        self.pairs += 1
        alone = [self.piece[i] for i in (a, b) if i >= 0]
        good = self.fits[a][b] = self.merged("".join(alone)) == alone
        return good

    def tokens(self, text: str) -> list[int]:
        """The tokens of a normalised text, by backtracking."""
        n, size, shorter, fits = len(text), self.size, self.shorter, self.fits
        longest = [-1] * n
        for last, i in self.trie.iter(text):  # by ends, so of those that begin at one place the longest comes last
            longest[last + 1 - size[i]] = i
        for at in [k for k, i in enumerate(longest) if i < 0]:
            longest[at] = self._character(text[at])
        failed = None
        out: list[int] = []
        before, at = -1, 0
        after = fits.setdefault(before, {})
        token = longest[0] if n else -1
        while at < n:
            while token >= 0:
                end = at + size[token]
                if failed is None or not failed[end >> 3] >> (end & 7) & 1:
                    good = after.get(token)
                    if good is None:
                        good = self.compatible(before, token)
                    if good:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                if end == n:
                    break
                before, at = token, end
                token = longest[at]
            else:
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                token = out.pop()
                at -= size[token]
                before = out[-1] if out else -1
                token = shorter[token]
            after = fits.get(before)
            if after is None:
                after = fits[before] = {}
        return out

    def decode(self, ids: list[int], begins: bool = True) -> str:
        """The text of ids: pieces joined, bytes read as UTF-8, and at a text's beginning the space that encoding put there removed."""
        out: list[str] = []
        raw = bytearray()
        for i in [*ids, -1]:
            if i in self.bytes:
                raw.append(self.bytes[i])
                continue
            if raw:
                out.append(_utf8(bytes(raw)))
                raw.clear()
                begins = False
            if i >= 0:
                piece = self.unknown_surface if i == self.unknown else self.surface[i]
                if begins and any(self.strips) and piece.startswith(" ") and i != self.unknown:
                    piece = piece[1:]
                    begins = self.strips[1]
                else:
                    begins = begins and not piece
                out.append(piece)
        return "".join(out)

    def _word(self, word: str) -> tuple[str, str]:
        """The ids of a piece of text joined by commas, and the text they decode to within a text."""
        known = self.words.get(word) or self.older.get(word)
        if known is None:
            tokens = self.tokens(word)
            known = ",".join([self.names[i] for i in tokens]), "".join([self.surface[i] for i in tokens])
        if len(word) <= CACHED_CHARS:
            if len(self.words) >= CACHE:  # words of the older generation that are met again move to the new one
                self.words, self.older = {}, self.words
            self.words[word] = known
        return known

    def cut(self, normal: str) -> list[str]:
        """A normalised text cut wherever no piece goes across."""
        if not normal:
            return []
        sign = self.sign[np.frombuffer(normal.encode("utf-32-le"), np.uint32)]
        ends = (np.flatnonzero(self.apart[sign[:-1] * self.kinds + sign[1:]]) + 1).tolist()
        return [normal[a:b] for a, b in zip([0, *ends], [*ends, len(normal)], strict=True)]

    def _parts(self, text: str) -> list[tuple[str, str]]:
        known = self.words.get
        return [known(w) or self._word(w) for w in self.cut(self.normalise(text))]

    def encode(self, text: str) -> list[int]:
        return [int(i) for p in self._parts(text) for i in p[0].split(",")]

    def both(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids joined by commas, and the decoded text."""
        parts = self._parts(text)
        line = ",".join([p[0] for p in parts])
        n = line.count(",") + 1 if line else 0
        if self.strips != (True, False) or not self.byte_ids:
            return n, line, self.decode([int(i) for i in line.split(",")] if line else [])
        back = "".join([p[1] for p in parts])
        # Encoding put a space before the text; exactly that one goes.
        return n, line, back[1:] if back.startswith(" ") else back


def _utf8(raw: bytes) -> str:
    """Bytes as UTF-8, one replacement sign for each byte that belongs to no character."""
    out, i = [], 0
    while i < len(raw):
        for k in (1, 2, 3, 4):
            try:
                out.append(raw[i : i + k].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k = 1
        i += k
    return "".join(out)


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder a worker process."""
    return PieceEncoder(path)


def _mapped(docs: DataFrame, path: str, schema: str, row: Callable[[PieceEncoder, str], tuple]) -> DataFrame:
    """doc_id and ``row`` of each text; tasks take texts in small Arrow batches."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        kinds = [pa.int64(), pa.string() if "ids string" in schema or "sha256" in schema else pa.list_(pa.int32()), pa.string()]
        names = [f.strip().split(" ")[0] for f in schema.split(",")]
        for batch in batches:
            found = [row(enc, t.as_py() or "") for t in batch.column(1)]
            columns = zip(*found, strict=True) if found else [[], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids (an array) and the text they decode to."""

    def row(enc: PieceEncoder, text: str) -> tuple:
        n, line, back = enc.both(text)
        return n, [int(i) for i in line.split(",")] if line else [], back

    return _mapped(docs, path, "doc_id long, n_tokens long, ids array<int>, decoded string", row)


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """Per row of ``encoded`` (doc_id, ids): doc_id and the text of its ids; null ids give the empty text."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [enc.decode(ids.as_py() or []) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, n_tokens and the SHA-256 of its ids' line and of its decoded text."""

    def row(enc: PieceEncoder, text: str) -> tuple:
        n, line, back = enc.both(text)
        return n, hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    return _mapped(docs, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", row)
