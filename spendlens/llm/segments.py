"""Cutting texts for byte-level tokenizers, and the caches of a worker.

Between two characters that are not white space, a single space starts a new pre-token, and nothing
on its left depends on what follows. So a text may be cut before such spaces and its parts encoded,
and cached, on their own. Python's notion of white space includes the tokenizer's, so a cut is
never made inside a run of white space.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable
from typing import Any

_CUT = re.compile(r"(?<=\S)(?= \S)")


def vocabulary_path(vocabulary: str) -> str:
    """A path as it is; a bare name is one of the public tokenizers' files on this machine."""
    if os.sep in vocabulary:
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def tokenizer(vocabulary: str):
    """The library's tokenizer, whole texts, one thread: Spark has the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(vocabulary_path(vocabulary))
    made.no_truncation()
    made.no_padding()
    return made


class SegmentCache:
    """Values of segments, kept for the life of a worker and begun anew beyond ``limit`` entries.

    ``encode`` gives the values of a list of new segments; ``special`` are strings that the
    tokenizer takes out of a text before all else; ``known`` is looked up first."""

    def __init__(self, encode: Callable[[list[str]], Iterable[Any]], special: list[str], limit: int = 500_000,
                 known: dict[str, Any] | None = None):
        self.encode, self.limit = encode, limit
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.known = known or {}
        self.plain: dict[str, Any] = {}  # the parts of a text split before every space; None if it must not be
        self.rough: dict[str, Any] = {}  # the parts of a text with longer runs of white space

    def _learn(self, cache: dict[str, Any], segments: set[str]) -> None:
        new = sorted(segments)
        cache.update(zip(new, self.encode(new)))

    @staticmethod
    def _uncuttable(segment: str) -> bool:
        body = segment[1:] if segment[:1] == " " else segment
        return not body or body[-1].isspace() or (body is not segment and body[0].isspace())

    def values(self, texts: list[str]) -> list[list[Any]]:
        """The values of each text's segments, in order."""
        if len(self.plain) > self.limit:
            self.plain = {}
        if len(self.rough) > self.limit:
            self.rough = {}
        known, plain, rough = self.known, self.plain, self.rough
        cut: list[list[tuple[bool, list[str]]]] = []
        new: set[str] = set()
        for text in texts:
            parts = self.special.split(text) if self.special and self.special.search(text) else [text]
            cut.append([("\0" not in part, part.replace(" ", "\0 ").split("\0") if "\0" not in part else [part])
                        for part in parts if part])
            for _, segments in cut[-1]:
                new.update(segments)
        new.difference_update(known, plain)
        for segment in [s for s in new if self._uncuttable(s)]:
            new.discard(segment)
            plain[segment] = None
        self._learn(plain, new)
        result, late = [], []
        for i, parts in enumerate(cut):
            values: list[Any] | None = []
            for simple, segments in parts:
                got = [known.get(s) or plain[s] for s in segments] if known else list(map(plain.__getitem__, segments))
                if not simple or None in got:
                    values = None
                    break
                values += got
            result.append(values)
            if values is None:
                late.append(i)
        split = {i: [s for part in (self.special.split(texts[i]) if self.special else [texts[i]]) if part
                     for s in _CUT.split(part)] for i in late}
        self._learn(rough, {s for segments in split.values() for s in segments} - rough.keys())
        for i in late:
            result[i] = [rough[s] for s in split[i]]
        return result
