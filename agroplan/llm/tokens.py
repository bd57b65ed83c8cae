"""Tokenising whole texts with the ``tokenizers`` library.

The library's cost is per word, and words recur. Texts are therefore cut at places where the tokenizer's
own pre-tokenisation cuts them too, and each distinct piece is encoded once per Python worker; the ids of
a text are those of its pieces, in order, exactly as when encoded at once. Cutting, telling pieces apart
and putting ids together are array operations on a whole batch.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces after which a worker begins a new memory; of the one before, it carries on with the pieces that come again.
REMEMBERED = 300_000
#: New pieces that are encoded in one call, set apart by a separator with an id of its own.
TOGETHER = 20_000
_WORKERS: dict[tuple[str, bool], Encoder] = {}
#: White space other than blank and newline; texts with it, or with white space beside white space, are cut with care.
_RARE = [c for c in map(chr, range(0x3001)) if (c.isspace() or c == "\u180e") and c not in " \n"]
_ODD = "^ | $|  | \n|\n |\n\n|\x00|[" + "".join(map(re.escape, _RARE)) + "]"
_CUT = re.compile("(?<=[^\\s\u180e]) (?=[^\\s\u180e])")
#: Begins a piece that no blank goes before.
_BARE = "\x00"
#: Finds pieces that may not stand between separators: white space, a separator, or the marks of a special token.
_APART = re.compile(r"[\s\x1c-\x1f\u180e]|<\|").search
#: A full stop or comma between a letter or digit and a blank is a pre-token of its own.
_STOP = "([0-9A-Za-zÀ-ÖØ-öø-ÿ])([.,]) "
#: Where a blank belongs to the word behind it, so is any run of ASCII punctuation there (but for the marks of a special token).
_STOPS = "([0-9A-Za-zÀ-ÖØ-öø-ÿ])([!-/:;=?@\\[-`{}~]+) "


class Encoder:
    """Encodes texts to id arrays.

    ``drops_space``: the tokenizer drops white space, so that any blank or newline is a cut. Otherwise
    a blank belongs to the word behind it; cuts are before single blanks and around single newlines
    between other characters.
    """

    def __init__(self, path: str, drops_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.drops_space = Tokenizer.from_file(path), drops_space
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.separator = " \x1f " if drops_space else "\n"
        (self.mark,) = self.tokenizer.encode(self.separator, add_special_tokens=False).ids
        self.lowers = self.tokenizer.encode("A", add_special_tokens=False).ids == self.tokenizer.encode("a", add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, new: list[str]) -> None:
        if self.drops_space:
            groups = [("", new, new)]
        else:
            bare, others = [k for k in new if k[:1] == _BARE], [k for k in new if k[:1] != _BARE]
            groups = [("", bare, [k[1:] for k in bare]), (" ", others, others)]
        for blank, keys, texts in groups:
            one_by_one = _APART("".join(texts))
            plain = [i for i, t in enumerate(texts) if t and not (one_by_one and _APART(t))]
            for at in range(0, len(plain), TOGETHER):
                part = plain[at : at + TOGETHER]
                ids = np.array(self.tokenizer.encode_batch_fast([blank + (self.separator + blank).join([texts[i] for i in part])], add_special_tokens=False)[0].ids, dtype=self.dtype)
                cuts = np.flatnonzero(ids == self.mark) * self.dtype.itemsize
                flat = ids.tobytes()
                begins, ends = [0, *(cuts + self.dtype.itemsize).tolist()], [*cuts.tolist(), len(flat)]
                self.known.update(zip([keys[i] for i in part], [flat[a:b] for a, b in zip(begins, ends, strict=True)], strict=True))
            if len(plain) < len(keys):
                rest = [i for i, k in enumerate(keys) if k not in self.known]
                self.known.update(zip([keys[i] for i in rest], self.whole([blank + texts[i] for i in rest]), strict=True))

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(found.ids, dtype=self.dtype).tobytes() for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All texts' pieces, and where each text's begin; all but bare ones stand for a blank and what is given."""
        if self.drops_space:
            flat = pc.replace_substring(texts, "\n", " ")  # (a fresh array: ascii_lower misreads slices)
            cut = pc.split_pattern(pc.replace_substring_regex(pc.ascii_lower(flat) if self.lowers else flat, _STOP, "\\1 \\2 "), " ")
            return cut.flatten(), cut.offsets.to_numpy().astype(np.int64)
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        bare, none = (pa.scalar(x, texts.type) for x in (_BARE, ""))
        marked = pc.replace_substring(pc.binary_join_element_wise(bare, texts, none), "\n", f" {_BARE}\n {_BARE}")
        cut = pc.split_pattern(pc.replace_substring_regex(marked, _STOPS, f"\\1 {_BARE}\\2 "), " ")
        offsets = cut.offsets.to_numpy().astype(np.int64)
        if not odd.any():
            return cut.flatten(), offsets
        parts, sizes = [], np.diff(offsets)
        for at, text in zip(np.flatnonzero(odd).tolist(), texts.filter(pa.array(odd)).to_pylist(), strict=True):
            own = _CUT.split(_BARE + text) if _BARE not in text else [_BARE + text]
            parts.append((at, pa.array(own, texts.type)))
        flat, chunks, last = cut.flatten(), [], 0
        for at, own in parts:
            chunks += [flat.slice(offsets[last], offsets[at] - offsets[last]), own]
            sizes[at], last = len(own), at + 1
        chunks.append(flat.slice(offsets[last], offsets[-1] - offsets[last]))
        return pa.concat_arrays(chunks), np.concatenate([[0], np.cumsum(sizes)])

    def ids(self, column: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another, each text's followed by ``end_id``, and their bounds by text; null is empty."""
        pieces, offsets = self.pieces(pc.fill_null(column.cast(pa.large_string()), ""))
        coded = pieces.dictionary_encode()
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        keys = coded.dictionary.to_pylist()
        new = [k for k in keys if k not in self.known]
        self.known.update((k, self.older[k]) for k in new if k in self.older)
        self.learn([k for k in new if k not in self.known] if self.older else new)
        coded_ids = list(map(self.known.__getitem__, keys))
        table = np.frombuffer(b"".join(coded_ids), dtype=self.dtype)
        sizes = np.fromiter(map(len, coded_ids), dtype=np.int64, count=len(keys)) // self.dtype.itemsize
        begins = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        per = sizes[at]
        ends = np.concatenate([[0], np.cumsum(per)])
        flat = table[np.repeat(begins[at] - ends[:-1], per) + np.arange(ends[-1])]
        bounds = ends[offsets]
        if end_id is None:
            return flat, bounds
        return np.insert(flat, bounds[1:], np.array(end_id, dtype=self.dtype)), bounds + np.arange(len(bounds))

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text, its ids as an array of ``dtype`` in bytes."""
        flat, bounds = self.ids(pa.array(texts, pa.large_string()))
        return [flat[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def encoder(path: str, drops_space: bool) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    key = (path, drops_space)
    if key not in _WORKERS:
        _WORKERS[key] = Encoder(path, drops_space)
    return _WORKERS[key]
