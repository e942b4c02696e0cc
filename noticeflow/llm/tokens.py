"""Token ids of whole texts with a public tokenizer file.

A text is cut at places where no token can cross, each distinct piece is encoded once by
the ``tokenizers`` library and remembered, and the ids of a text are the ids of its
pieces in order. The memory is bounded: a full one drops the pieces that did not come
again, which costs time and changes nothing.

* ``words``: pieces are runs of anything but ASCII white space, without a stop or comma
  between a letter and such white space, which is a piece of its own. For tokenizers that
  drop white space.
* ``spaced``: the same, but a piece begins with the white space before it. For byte-level
  tokenizers whose tokens carry the blank before a word.

A piece of plain letters, perhaps with a line feed before, is cut alike by both patterns;
its parts go straight to the library's BPE model. All other pieces take
the library's whole path.

The literals of the file's special tokens (as ``<|endoftext|>``) are tokens of their own, as
the library takes them by default: with ``special`` a text is first split at them, before all
other cuts, as the library does. Without it they are plain text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .common import text_chunks

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# A cut is made before ASCII white space that follows something no tokenizer takes for
# white space (other blanks stay inside their piece), and on both sides of a stop or comma
# between a letter and such white space.
_STOP = rf"([{_LETTERS}])([.,])([ \t-\r])"
_CUT = _STOP + r"|([^\s\x0b\p{Z}\x1c-\x1f\x{85}\x{180e}\x{200b}\x{feff}])([ \t-\r])"
_MARK = "\0"
_SPACED = re.compile(r"\s*\S+(?:[^\S\x20\x09-\x0D]\s*\S*)*|\s+")
_PLAIN = re.compile(rf"(\n?)( ?[{_LETTERS}]+)")
_PLAIN_WORD = re.compile(rf"()([{_LETTERS}]+)")
REMEMBERED, KEPT = 500_000, 500_000
# Texts are encoded in portions: the larger, the fewer pieces are looked up again.
ENCODE_BYTES = 8 << 20


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte that byte-level BPE files use.

    Printable Latin-1 characters stand for themselves, the others for U+0100 and on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()
_BLANK = _BYTE_LETTERS[32]


class PieceEncoder:
    """Encodes Arrow arrays of texts to flat ids and a length per text."""

    def __init__(self, path: str, cut: str, remembered: int = REMEMBERED, special: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.literal = _literal(self.tokenizer) if special else None
        self.model = self.tokenizer.model
        self.words = cut == "words"
        self.remembered = remembered
        self._start()

    def _start(self) -> None:
        self.index: dict[str, int] = {}
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.hits = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def shrink(self, most: int) -> None:
        """Keep the pieces that came again, at most so many, the most frequent first."""
        again = np.flatnonzero(self.hits > 1)
        if len(again) > most:
            again = np.sort(again[np.argsort(-self.hits[again], kind="stable")[:most]])
        pieces = list(self.index)
        self.flat = self.flat[_places(self.starts[again], self.lengths[again])]
        self.lengths = self.lengths[again]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.hits = np.zeros(len(again), np.int64)
        self.index = {pieces[i]: n for n, i in enumerate(again.tolist())}

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """How many pieces each text has, and all pieces."""
        if self.words:
            texts = pc.replace_substring_regex(texts, _STOP, r"\1 \2\3")
            lists = pc.ascii_split_whitespace(texts)
        elif pc.any(pc.match_substring(texts, _MARK)).as_py():
            lists = pa.array([_SPACED.findall(t) for t in texts.to_pylist()], pa.list_(pa.string()))
        else:
            marked = pc.replace_substring_regex(texts, _CUT, rf"\1\4{_MARK}\2{_MARK}\3\5")
            lists = pc.split_pattern(marked, _MARK)
        # Cuts leave empty pieces between them; these have no ids.
        return lists.value_lengths().to_numpy(), lists.flatten()

    def _plain(self, piece: str) -> list[int] | None:
        if not piece:
            return []
        if self.words:
            if piece.isascii() and piece.isalpha():
                return [t.id for t in self.model.tokenize(piece.lower())]
        elif piece[0] == " " and piece.isascii() and piece[1:].isalpha():
            return [t.id for t in self.model.tokenize(_BLANK + piece[1:])]
        found = (_PLAIN_WORD if self.words else _PLAIN).fullmatch(piece)
        if found is None:
            return None
        feed, stem = found.groups()
        stem = (stem.lower() if self.words else stem).encode().decode("latin-1")
        parts = (feed.translate(_BYTE_LETTERS), stem.translate(_BYTE_LETTERS))
        return [t.id for part in parts if part for t in self.model.tokenize(part)]

    def _learn(self, pieces: list[str]) -> None:
        ids = list(map(self._plain, pieces))
        odd = [i for i, found in enumerate(ids) if found is None]
        whole = self.tokenizer.encode_batch_fast([pieces[i] for i in odd], add_special_tokens=False)
        for i, found in zip(odd, whole):
            ids[i] = found.ids
        first = len(self.index)
        self.index.update(zip(pieces, range(first, first + len(pieces))))
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.hits = np.concatenate([self.hits, np.zeros(len(ids), np.int64)])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and ids per text; NULL is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if self.literal is None or not pc.any(pc.match_substring_regex(texts, self.literal.pattern)).as_py():
            return self._encode(texts)
        parts = [self.literal.split(t) for t in texts.to_pylist()]
        ids, sizes = self._encode(pa.array(list(chain.from_iterable(parts)), pa.string()))
        return ids, np.add.reduceat(sizes, np.cumsum([0, *map(len, parts)])[:-1])

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        counts, pieces = self._cut(texts)
        if not len(pieces):
            return np.zeros(0, np.uint32), counts
        if len(self.index) > self.remembered:
            self.shrink(self.remembered // 2)
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
        unseen = np.flatnonzero(known < 0)
        if len(unseen):
            known[unseen] = np.arange(len(self.index), len(self.index) + len(unseen))
            self._learn([distinct[i] for i in unseen.tolist()])
        self.hits[known] += 1
        which = known[coded.indices.to_numpy()]
        sizes = self.lengths[which]
        ids = self.flat[_places(self.starts[which], sizes)]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(edges[np.concatenate([[0], np.cumsum(counts)])])


def _literal(tokenizer: Tokenizer) -> re.Pattern | None:
    """Matches the literals of a tokenizer file's own tokens, longer ones first."""
    tokens = tokenizer.get_added_tokens_decoder().values()
    for t in tokens:
        if t.normalized or t.lstrip or t.rstrip or t.single_word:
            raise ValueError(f"{t.content}: only tokens that stand for their exact literal can be split off")
    contents = sorted((t.content for t in tokens), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, contents)) + ")") if contents else None


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of runs that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def encoded(batches, path: str, cut: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Portions of batches with their texts' ids and lengths.

    A worker process keeps its encoder for later tasks, but only with its commonest pieces.
    """
    own = encoder(path, cut)
    for batch in text_chunks(batches, limit=ENCODE_BYTES):
        yield batch, *own.encode(batch.column("text"))
    own.shrink(KEPT)


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder(path: str, cut: str) -> PieceEncoder:
    """One encoder per worker process and tokenizer file."""
    if (path, cut) not in _ENCODERS:
        _ENCODERS[path, cut] = PieceEncoder(path, cut, special=True)
    return _ENCODERS[path, cut]
