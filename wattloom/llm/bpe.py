"""Token ids of whole texts by the ``tokenizers`` library, piece by piece.

A byte-level BPE never merges across a single space that stands between two
characters other than white space: the space opens the next pre-token. A text is cut
there, each distinct piece is encoded once per worker, and the ids of a text are
gathered from its pieces. A text with a piece that starts or ends in white space is
cut more carefully. A piece of ASCII letters and marks is split into pre-tokens here
and goes to the tokenizer's model at once; any other piece goes through the whole
tokenizer. The ids equal those of encoding the whole text.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
# Latin letters, then marks: two pre-tokens of a byte-level tokenizer. An apostrophe
# may open a contraction and is left out.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ſ]*)([!\"#$%&()*+,./:;=?@\[\]^_`{|}~-]*)")
_SPACED = re.compile(r" ([A-Za-zÀ-ÖØ-öø-ſ]+)([!\"#$%&()*+,./:;=?@\[\]^_`{|}~-]*)")


def _byte_names() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary:
    printable bytes for themselves, the others in order from 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + n) for n, b in enumerate(moved)}


_NAMES = _byte_names()
_SPACE_BYTE = _NAMES[0x20]
_ONE_FEED = re.compile(r" ?\S+\n\S+")
# A worker keeps at most this many pieces and ids between slices of a batch.
MAX_PIECES = 700_000
MAX_IDS = 6_000_000
WORDS_AT_ONCE = 64
SLICE_BYTES = 4_000_000
END_ID = 0


class _Index(dict):
    """Piece -> number in the store; a new piece is queued for encoding."""

    def __init__(self, queue: list[str], prefix: str, base: list[int]):
        super().__init__()
        self.queue, self.prefix, self.base = queue, prefix, base

    def __missing__(self, piece: str) -> int:
        number = self[piece] = self.base[0]
        self.base[0] += 1
        self.queue.append(self.prefix + piece)
        return number


class Encoder:
    """Encodes batches of texts; one per Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.direct = (
            isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)
            and not self.tokenizer.pre_tokenizer.add_prefix_space
            and self.tokenizer.normalizer is None
            and self.tokenizer.post_processor is None
        )
        vocabulary = self.tokenizer.get_vocab()
        # Words may share a call of the model if no token holds a space after another
        # character: then the tokens that start with a space show where words start.
        self.joined = self.direct and not any(_SPACE_BYTE in t.lstrip(_SPACE_BYTE) for t in vocabulary)
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for t, i in vocabulary.items() if t[0] == _SPACE_BYTE]] = True
        self._reset()

    def _reset(self) -> None:
        self.queue: list[str] = []
        base = [0]
        self.count = base
        self.spaced = _Index(self.queue, " ", base)
        self.heads = _Index(self.queue, "", base)
        self.marks: dict[str, list[int]] = {"": []}
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.unsafe = np.zeros(0, bool)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _model_ids(self, pre_token: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(pre_token)]

    def _marks_ids(self, marks: str) -> list[int]:
        if marks not in self.marks:
            self.marks[marks] = self._model_ids(marks)
        return self.marks[marks]

    def _piece_ids(self, piece: str) -> list[int]:
        """Ids of one piece with its leading space, if it has one."""
        spaced = piece[:1] == " "
        simple = _SIMPLE.fullmatch(piece, 1 if spaced else 0) if self.direct else None
        if simple is None:
            if self.direct and piece.count("\n") == 1 and _ONE_FEED.fullmatch(piece):
                # A lone line feed between two other characters is a pre-token.
                left, right = piece.split("\n")
                return self._piece_ids(left) + self._marks_ids(_NAMES[0x0A]) + self._piece_ids(right)
            return self._ids([piece])[0]
        if simple[2] and any(s in piece for s in self.special):
            return self._ids([piece])[0]
        word, marks = simple.groups()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_NAMES)
        lead = _SPACE_BYTE if spaced else ""
        if not word:
            return self._model_ids(lead + marks) if lead + marks else []
        return self._model_ids(lead + word) + self._marks_ids(marks)

    def _word_ids(self, words: list[str]) -> tuple[list[int], list[int]]:
        """Ids of words that start with the space byte, and where each word ends."""
        ids: list[int] = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            ids.extend([t.id for t in self.tokenizer.model.tokenize("".join(words[at : at + WORDS_AT_ONCE]))])
        starts = np.flatnonzero(self.opens[np.array(ids, np.int64)]) if ids else np.zeros(0, np.int64)
        if len(starts) != len(words):
            raise ValueError("the vocabulary merges across spaces")
        return ids, [*starts[1:].tolist(), len(ids)] if words else []

    def _absorb(self) -> None:
        """Encode the queued pieces."""
        if not self.queue:
            return
        simple: list[str | None] = []
        words: list[str] = []
        for piece in self.queue:
            match = _SPACED.fullmatch(piece) if self.joined else None
            if match is None or (match[2] and any(s in piece for s in self.special)):
                simple.append(None)
                continue
            word = match[1]
            words.append(_SPACE_BYTE + (word if word.isascii() else word.encode().decode("latin-1").translate(_NAMES)))
            simple.append(match[2])
        known, stops = self._word_ids(words)
        stop = iter(stops)
        ids: list[int] = []
        ends = []
        begin = 0
        for piece, marks in zip(self.queue, simple):
            if marks is None:
                ids.extend(self._piece_ids(piece))
            else:
                end = next(stop)
                ids.extend(known[begin:end])
                begin = end
                if marks:
                    ids.extend(self._marks_ids(marks))
            ends.append(len(ids))
        lengths = np.diff(np.array(ends), prepend=0)
        flat = np.array(ids, np.uint32)
        # The space in front of a piece is its own; white space at its edges is not.
        unsafe = [q[0] == " " and (len(q) == 1 or q[1].isspace()) or q[-1].isspace() if q else False for q in self.queue]
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.flat = np.concatenate([self.flat, flat])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.unsafe = np.concatenate([self.unsafe, np.array(unsafe, bool)])
        self.queue.clear()

    def _careful(self, text: str) -> np.ndarray:
        pieces = _SAFE_CUT.split(text)
        ends = self._ids([pieces[0], " " + pieces[-1] if len(pieces) > 1 else ""])
        numbers = np.fromiter(map(self.spaced.__getitem__, pieces[1:-1]), np.int64, max(0, len(pieces) - 2))
        self._absorb()
        middle, _ = self._gather(numbers)
        return np.concatenate([np.array(ends[0], np.uint32), middle, np.array(ends[1], np.uint32)])

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[numbers] - ends + lengths, lengths) + np.arange(total)
        return self.flat[at], ends

    def _encode(self, texts: pa.Array) -> list[np.ndarray]:
        if self.count[0] > MAX_PIECES or len(self.flat) > MAX_IDS:
            self._reset()
        cut = pc.split_pattern(texts, " ")
        offsets = cut.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = cut.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        spaced = np.ones(len(codes), bool)
        spaced[offsets[:-1]] = False
        used = np.zeros(len(distinct), bool)
        used[codes[spaced]] = True
        number = np.zeros(len(distinct), np.int64)
        at = np.flatnonzero(used)
        number[at] = np.fromiter(map(self.spaced.__getitem__, map(distinct.__getitem__, at.tolist())), np.int64, len(at))
        numbers = number[codes]
        firsts = [distinct[k] for k in codes[offsets[:-1]].tolist()]
        numbers[offsets[:-1]] = np.fromiter(map(self.heads.__getitem__, firsts), np.int64, len(firsts))
        self._absorb()
        ids, ends = self._gather(numbers)
        stops = ends[offsets[1:] - 1]
        begins = np.concatenate([[0], stops[:-1]])
        careful = np.logical_or.reduceat(self.unsafe[numbers], offsets[:-1])
        return [
            self._careful(texts[k].as_py()) if careful[k] else ids[b:e]
            for k, (b, e) in enumerate(zip(begins.tolist(), stops.tolist()))
        ]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers; a null text has none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy())
        begin = 0
        while begin < len(texts):
            done = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, "right")))
            yield from self._encode(texts.slice(begin, end - begin))
            begin = end


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
