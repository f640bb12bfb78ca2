"""Token ids from a vocabulary file, with a bounded cache of encoded words.

``tokenizers`` (.json) splits a text before its merges, and a single space
before a non-space character always begins a new part.  A text is therefore
cut there, each distinct piece is encoded once by the library, and the ids of
the text are those of its pieces in a row.  Around longer runs of white space,
where the split looks ahead, the text is left whole between single spaces.
``sentencepiece`` (.model) encodes whole texts.
"""

from __future__ import annotations

import re
import struct
import sys
import types
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import numpy as np

#: Pieces kept between batches, and between tasks; pieces handed to the library at once, and as the words of a text.
CACHED, KEPT, CHUNK, WORDS = 700_000, 450_000, 4096, 128


def locator(file: str) -> Callable[[], str]:
    """Place of a public vocabulary file, found where the task runs."""

    def place() -> str:
        import public_tokenizers

        return public_tokenizers.path(file)

    return place


def cuts_at_spaces(tokenizer_json: str) -> bool:
    """Whether this vocabulary splits as described above: byte-level, nothing
    normalised, nothing added but whole special strings without a space."""
    import json

    t = json.loads(tokenizer_json)
    pre = t.get("pre_tokenizer") or {}
    return (
        t.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
        and not pre.get("add_prefix_space") and t["model"].get("type") == "BPE"
        and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"])
                    for a in t.get("added_tokens", []))
    )


def pieces(text: str) -> list[str]:
    """The text cut before single spaces; a piece but the first has its space
    taken off, unless it begins with a line break.  Where spaces or line breaks
    follow each other, or there is other white space, the text is cut only at
    spaces between characters that are none."""
    if (
        text[:1] in (" ", "\n") or text[-1:] in (" ", "\n")
        or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or re.search(r"[^\S \n]", text)
    ):
        return re.split(r"(?<=\S) (?=\S)", text)
    return text.replace("\n", " \n").split(" ")


def encoder(path: str) -> Encoder:
    """The encoder of this process: its cache serves all tasks that run here."""
    held = sys.modules.setdefault("_quarry_encoders", types.ModuleType("_quarry_encoders"))
    if getattr(held, "path", None) != path:
        held.encoder, held.path = Encoder(path), path
    return held.encoder


class Encoder:
    """ids(texts): the ids of each text as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the machine
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda texts: [as_bytes(i) for i in model.encode(list(texts), num_threads=1)]
            self.cut = False
            return
        import tokenizers

        tokenizer = tokenizers.Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.whole = lambda texts: [as_bytes(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as f:
            self.cut = cuts_at_spaces(f.read())
        self.tokenizer = tokenizer

    def ids(self, texts: Sequence[str]) -> list[bytes]:
        if not self.cut:
            return self.whole(list(texts))
        cut = [pieces(t) for t in texts]
        new = self._learn(self.first, {p[0] for p in cut}, lambda p: p)
        seen: set[str] = set()
        for p in cut:
            seen.update(islice(p, 1, None))
        added = self._learn(self.later, seen, lambda p: p if p[:1] == "\n" else " " + p)
        out = [self.first[p[0]] + b"".join(map(self.later.__getitem__, islice(p, 1, None))) for p in cut]
        for cache, keys in ((self.first, new), (self.later, added)):
            if len(cache) > CACHED:
                for k in keys:
                    del cache[k]
        return out

    def rest(self) -> None:
        """Keep the pieces learned first (the common ones) and free the others' memory until the next task."""
        for cache in (self.first, self.later):
            kept = dict(islice(cache.items(), KEPT))
            cache.clear()
            cache.update(kept)

    def _learn(self, cache: dict[str, bytes], seen: set[str], written) -> list[str]:
        new = list(seen.difference(cache))
        for k in range(0, len(new), CHUNK):
            some = new[k:k + CHUNK]
            cache.update(zip(some, self._apart([written(p) for p in some])))
        return new

    def _apart(self, written: list[str]) -> Iterator[bytes]:
        """The ids of every piece.  The library gets them as the words of a few texts and says which word each id is of:
        cheaper than a text for each."""
        groups = [written[k:k + WORDS] for k in range(0, len(written), WORDS)]
        for group, e in zip(groups, self.tokenizer.encode_batch(groups, is_pretokenized=True, add_special_tokens=False)):
            data = as_bytes(e.ids)
            ends = (4 * np.cumsum(np.bincount(np.array(e.word_ids, np.int64), minlength=len(group)))).tolist()
            yield from (data[a:b] for a, b in zip([0, *ends], ends))


def as_bytes(ids: Sequence[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)
