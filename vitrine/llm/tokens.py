"""Encoding of whole texts with a public tokenizer, at the cost of its distinct pieces.

Both supported kinds of tokenizer split a text before they merge anything, and no merge crosses a split. A text is
therefore cut at places where the tokenizer cuts as well, each distinct piece is encoded once, and the ids of the
texts are put together from a bounded cache. Cuts are found in the bytes of all texts of a batch at once. Texts in which
a cut could be wrong (runs of blanks) and texts that may hold a special token are encoded as a whole, so ids are
those that the library gives. ``tests/llm`` holds the result against encoding whole texts.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vitrine.llm.batches import kept_in_worker

CACHED_PIECES = 1_000_000
LONGEST_CACHED = 64
AT_ONCE = 512
END_ID = 0

# All that any library takes for a blank.
_BLANK = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# With such a run, a cut before one of its spaces could fall inside a piece of the byte-level kind.
_RUNS = f"{_BLANK}{{3}}|{_BLANK}{{2}}$"

_LETTER, _MARK, _LINE, _SPACE, _WHITE, _SOLID = 1, 2, 4, 8, 16, 32


def _kinds() -> np.ndarray:
    """What each byte is; bytes of other characters than ASCII are nothing, so nothing is cut beside them."""
    kinds = np.zeros(256, np.uint8)
    for byte in range(128):
        c = chr(byte)
        kinds[byte] = (
            _LETTER * (c.isascii() and c.isalpha())
            | _MARK * (c in ".,;:!?#%&$*|")
            | _LINE * (c == "\n")
            | _SPACE * (c == " ")
            | _WHITE * (c in " \t\n\v\f\r")
            | _SOLID * (byte > 32 and byte != 127)
        )
    return kinds


class Encoder:
    """``split`` is ``blank`` (blanks are dropped) or ``space`` (byte level, blanks are kept)."""

    def __init__(self, path: str, split: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._space = {"blank": False, "space": True}[split]
        # Special tokens may be looked for after changes of case and the like; these beginnings survive them.
        special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._marks = sorted({s[:2] for s in special})
        self._kinds = _kinds()
        self._cache: dict[str, bytes] = {}

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces by the tokenizer, which takes many of them at a time and tells whose each id is."""
        found = []
        for at in range(0, len(pieces), AT_ONCE):
            part = pieces[at : at + AT_ONCE]
            e = self._tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids = array("I", e.ids).tobytes()
            ends = np.searchsorted(np.array(e.word_ids, np.int64), np.arange(len(part)), side="right") * 4
            start = 0
            for end in ends.tolist():
                found.append(ids[start:end])
                start = end
        return found

    def _encoded_whole(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, special tokens included."""
        return [array("I", e.ids).tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _looked_up(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        found = list(map(self._cache.get, pieces))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = [pieces[i] for i in missing]
        if len(self._cache) + len(new) > CACHED_PIECES:
            self._cache = {}
        for i, piece, ids in zip(missing, new, self._encoded(new)):
            found[i] = ids
            if len(piece) <= LONGEST_CACHED:
                self._cache[piece] = ids
        return found

    def _uncut(self, texts: pa.Array) -> np.ndarray:
        """Texts to encode as a whole."""
        found = np.zeros(len(texts), bool)
        for mark in self._marks:
            found |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        if self._space:
            found |= pc.match_substring_regex(texts, _RUNS).to_numpy(zero_copy_only=False)
        return found

    def _cuts(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Places of the bytes before which to cut; ``starts`` are those of the texts."""
        kind = self._kinds[data]
        cut = (kind & (_SPACE if self._space else _WHITE)) > 0
        begins = np.zeros(len(data) + 1, bool)
        begins[starts] = True
        begins[len(data)] = True
        if len(data) > 1:
            before, here = kind[:-1], kind[1:]
            # A letter and a mark or line end; a mark and a line end that goes on; a line end after something and a letter.
            cut[1:] |= (before & _LETTER > 0) & (here & (_MARK | _LINE) > 0)
            cut[1:-1] |= (before[:-1] & _MARK > 0) & (here[:-1] & _LINE > 0) & (here[1:] & _SOLID > 0) & ~begins[2:-1]
            cut[2:] |= (before[:-1] & _SOLID > 0) & (before[1:] & _LINE > 0) & (here[1:] & _LETTER > 0) & ~begins[1:-2]
        cut |= begins[:-1]
        return np.flatnonzero(cut)

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each followed by the end id, and the place where each text ends.

        A missing text is empty.
        """
        texts = pc.fill_null(texts.cast(pa.string()), "")
        uncut = self._uncut(texts)
        wholes = [texts[i].as_py() for i in np.flatnonzero(uncut).tolist()]
        if wholes:
            texts = pc.if_else(pa.array(uncut), "", texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        cuts = self._cuts(data, offsets[:-1][offsets[:-1] < offsets[1:]])
        places = np.append(cuts, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.string(), len(cuts), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy()
        pool = self._looked_up(coded.dictionary.to_pylist())
        # After the pieces of a text come its ids as a whole, if it was not cut, and the end id.
        ends = np.searchsorted(cuts, offsets[1:])
        at, values = [ends], [np.full(len(texts), len(pool) + len(wholes))]
        if wholes:
            at.insert(0, ends[uncut])
            values.insert(0, len(pool) + np.arange(len(wholes)))
        pool = [*pool, *self._encoded_whole(wholes), END_ID.to_bytes(4, "little")]
        at, values = np.concatenate(at), np.concatenate(values)
        order = np.argsort(np.concatenate([np.flatnonzero(uncut) * 2, np.arange(len(texts)) * 2 + 1]), kind="stable")
        codes = np.insert(codes, at[order], values[order])
        # 32 bits reach for the ids of a batch of texts.
        sizes = np.fromiter(map(len, pool), np.int32, len(pool)) // 4
        firsts = np.cumsum(sizes, dtype=np.int32) - sizes
        lengths = sizes[codes]
        after = np.cumsum(lengths, dtype=np.int32)
        source = np.repeat(firsts[codes] - (after - lengths), lengths)
        source += np.arange(len(source), dtype=np.int32)
        # The end of a text is that of its end id: there are as many inserted codes before it as texts and wholes.
        inserted = ends + np.arange(len(texts)) + np.cumsum(uncut)
        return np.frombuffer(b"".join(pool), "<u4")[source], after[inserted]


def encoder(path: str, split: str) -> Encoder:
    """The encoder of this worker process: its cache serves all tasks that the process runs."""
    return kept_in_worker(f"encoder {split} {path}", lambda: Encoder(path, split))
