"""BPE encoding and decoding by tree concatenation.

A text is normalised and cut into pre-tokens as the tokenizer's file says. Short
pre-tokens are encoded by the library, once per worker (a bounded cache keeps them).
A long unsplit pre-token is encoded as a tree: it is halved until the pieces are
short, the pieces are encoded in one parallel batch, and neighbours are joined upwards.
A join re-encodes a window around it: a few tokens of either side, twice as many each
time, until both seams agree, that is until the last token outside the window and the
first token inside encode to exactly themselves, on both sides. A sequence of tokens
of a merge-ordered BPE is the encoding of its text exactly if all its neighbours agree
in that sense, so the result equals encoding the whole, at a cost in proportion to the
length.

Texts with the strings of special tokens are cut at them first, as the library does.

Edge cases: null and empty texts have no tokens and decode to the empty text; repeated
rows, null ids and other columns are passed over; long texts take memory in proportion.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer
from tokenizers.models import BPE

from rowsmith.llm._io import small_batches

#: Characters of a pre-token encoded directly; longer ones are halved.
LEAF = 512
#: Tokens of each side in a join's first window.
WINDOW = 4
#: Words that one worker keeps, in two generations of this size.
CACHE = 1 << 17
#: Texts of these signs normalise alike here and in the library: composed Latin letters, plain white space.
_SIMPLE = re.compile("[\t-\r\x20-\x7e\xa1-\u017e]*")


class TreeEncoder:
    """Encodes like ``tokenizers.Tokenizer.from_file(path)`` with add_special_tokens=False."""

    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW):
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.leaf, self.window = leaf, window
        self.added = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        # Without a decoder the library joins tokens by spaces, so words decode one by one.
        self.plain = self.tok.decoder is None
        norm = json.loads(self.tok.to_str())["normalizer"] or {}
        self.simple = [n["type"] for n in norm.get("normalizers", [norm])] == ["NFC", "Replace", "Lowercase"]
        self.cache: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}
        self.agreed: dict[tuple[int, int], bool] = {}
        self._open: Tokenizer | None = None
        self.end = self.tok.model.end_of_word_suffix or ""

    # -- one pre-token
    def _model(self, piece: str) -> list[tuple[int, str]]:
        return [(t.id, t.value) for t in self.tok.model.tokenize(piece)]

    def _leaf(self, piece: str, last: bool) -> list[tuple[int, str]]:
        """Tokens of a piece; the end-of-word mark belongs to a word's last piece only."""
        return self._model(piece) if last or not self.end else self._inner([piece])[0]

    def _inner(self, pieces: list[str]) -> list[list[tuple[int, str]]]:
        """Encode pieces that don't end their word, all in one parallel batch."""
        if self._open is None:
            model = json.loads(self.tok.to_str())["model"]
            merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
            self._open = Tokenizer(BPE(vocab=model["vocab"], merges=merges))
        return [list(zip(x.ids, x.tokens, strict=True)) for x in self._open.encode_batch(pieces, add_special_tokens=False)]

    def _agree(self, a: tuple[int, str], b: tuple[int, str], closes: bool) -> bool:
        """Whether tokens a, b side by side encode to exactly themselves."""
        key = (a[0], b[0])
        if key not in self.agreed:
            if len(self.agreed) > CACHE:
                self.agreed.clear()
            text = a[1] + (b[1].removesuffix(self.end) if closes and self.end else b[1])
            self.agreed[key] = [t[0] for t in self._leaf(text, closes)] == [a[0], b[0]]
        return self.agreed[key]

    def _closes(self, token: tuple[int, str]) -> bool:
        return bool(self.end) and token[1].endswith(self.end)

    def _text(self, tokens: list[tuple[int, str]], closes: bool) -> str:
        text = "".join(t[1] for t in tokens)
        return text.removesuffix(self.end) if closes and self.end else text

    def _join(self, left: list, right: list, last: bool) -> list:
        """The encoding of both sides' text, from the encodings of each."""
        if self._agree(left[-1], right[0], last and len(right) == 1):
            return left + right
        k = self.window
        while True:
            a, b = left[:-k] if k < len(left) else [], right[k:] if k < len(right) else []
            inner = left[len(a) :] + right[: len(right) - len(b)]
            closes = last and not b
            middle = self._leaf(self._text(inner, closes), closes)
            before = not a or self._agree(a[-1], middle[0], closes and len(middle) == 1)
            after = not b or self._agree(middle[-1], b[0], last and len(b) == 1)
            if before and after:
                return a + middle + b
            k *= 2

    def pre_token(self, piece: str) -> list[tuple[int, str]]:
        """Tokens of one pre-token (in the model's alphabet), as a tree if it is long."""
        if len(piece) <= self.leaf:
            return self._model(piece)
        parts = [piece]
        while len(parts[0]) > self.leaf:
            parts = [x for p in parts for x in (p[: len(p) // 2], p[len(p) // 2 :])]
        nodes = [*self._inner(parts[:-1]), self._model(parts[-1])]
        while len(nodes) > 1:
            nodes = [self._join(nodes[i], nodes[i + 1], i + 2 == len(nodes)) for i in range(0, len(nodes), 2)]
        return nodes[0]

    # -- texts
    def _word(self, word: str) -> tuple[int, str, str]:
        """Number of ids, the ids' line and the decoded line of a normalised piece without spaces.
        White space separates pre-tokens and is dropped, so such pieces are independent."""
        known = self.cache.get(word) or self.older.get(word)
        if known is None:
            tokens = [t for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(word) for t in self.pre_token(piece)]
            known = (len(tokens), " ".join([str(i) for i, _ in tokens]), " ".join([v for _, v in tokens]))
        if len(word) <= 64:
            if len(self.cache) >= CACHE:  # words of the older generation that are met again move to the new one
                self.cache, self.older = {}, self.cache
            self.cache[word] = known
        return known

    def _words(self, part: str) -> list[str]:
        """The normalised text between white space."""
        if self.simple and _SIMPLE.fullmatch(part):
            return part.lower().split()
        return [w for w in self.tok.normalizer.normalize_str(part).split(" ") if w] if part else []

    def both(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids in decimal joined by one space, and the decoded text."""
        n, ids, back = 0, [], []
        for part in self.cut.split(text) if self.cut is not None and self.cut.search(text) else (text,):
            if part in self.added:
                found = [(1, str(self.added[part]), part)]
            else:
                known = self.cache.get
                found = [known(w) or self._word(w) for w in self._words(part)]
            n += sum([f[0] for f in found])
            ids += [f[1] for f in found if f[0]]
            back += [f[2] for f in found if f[0]]
        line = " ".join(ids)
        return n, line, " ".join(back) if self.plain else self.decode([int(x) for x in line.split()])

    def encode(self, text: str) -> tuple[int, str]:
        return self.both(text)[:2]

    def decode(self, ids: list[int]) -> str:
        return self.tok.decode(ids, skip_special_tokens=False)


@lru_cache(maxsize=2)
def encoder(path: str) -> TreeEncoder:
    """One encoder a worker process."""
    return TreeEncoder(path)


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids (decimal, joined by one space), decoded."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            n, ids, back = [], [], []
            for t in batch.column(1):
                count, line, decoded = enc.both(t.as_py() or "")
                n.append(count)
                ids.append(line)
                back.append(decoded)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids string, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, n_tokens and the SHA-256 of its ids' line and of its decoded text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            n, ids, back = [], [], []
            for t in batch.column(1):
                count, line, decoded = enc.both(t.as_py() or "")
                n.append(count)
                ids.append(hashlib.sha256(line.encode()).hexdigest())
                back.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
