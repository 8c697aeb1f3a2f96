"""Byte-level BPE by pre-tokens with worker caches.

Byte-level BPE never merges across the boundary before a space that a visible
character follows, so a text is cut there and each part ("pre-token": the space and
what follows up to the next such space) is encoded on its own and remembered. The
concatenated results equal those of the library on the whole text; texts that hold
an added special string go to the library whole.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable
from itertools import chain, islice

# A space before white space or at the end: the plain split at every space is then too fine.
_ODD_SPACE = re.compile(r" (?:[\s\x1c-\x1f\x85]|$)")
_CUT = re.compile(r" (?=[^\s\x1c-\x1f\x85])")
#: Longer pre-tokens are encoded each time and not kept.
MAX_KEPT_CHARS = 48

_LOADED: dict[str, tuple[object, re.Pattern | None]] = {}


def load(path: str):
    """The tokenizer of a file and a pattern of its added strings; once per worker."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        added = [t.content for t in tok.get_added_tokens_decoder().values()]
        _LOADED[path] = tok, re.compile("|".join(map(re.escape, added))) if added else None
    return _LOADED[path]


def cut(text: str) -> list[str]:
    """The pre-tokens of a text, without the single space that starts all but the first."""
    return _CUT.split(text) if _ODD_SPACE.search(text) else text.split(" ")


class PretokenCache(dict):
    """What ``value`` makes of the ids of each pre-token; misses are encoded and kept.

    ``frequent`` is given and stays. When ``max_kept`` entries are held, they become the
    old generation: looked up once more when missed, dropped when the next one is full.
    ``value`` turns a list of ids into what is remembered (their number, or their bytes).
    """

    def __init__(self, path: str, value: Callable, frequent: dict | None = None, max_kept: int = 300_000):
        super().__init__(frequent or {})
        self.frequent, self.value, self.max_kept = frequent or {}, value, max_kept
        self.tok, self.special = load(path)
        self.old: dict = {}
        self.mark = {p: self.encoded(p) for p in ".,"}

    def encoded(self, text: str):
        return self.value(self.tok.encode(text, add_special_tokens=False).ids)

    def __missing__(self, part: str):
        if part in self.old:
            got = self.old[part]
        elif part[-1:] in self.mark and part[-2:-1].isalpha():
            got = self[part[:-1]] + self.mark[part[-1]]  # a letter before a final mark ends a token
        else:
            got = self.encoded(" " + part)
        if len(part) <= MAX_KEPT_CHARS:
            self[part] = got
        return got

    def texts(self, texts: list[str | None], join: Callable) -> list:
        """The joined value of each text; ``join`` takes an iterable of values."""
        if len(self) > self.max_kept:
            self.old = dict(self)
            self.clear()
            self.update(self.frequent)
        out, known = [], self.__getitem__
        for t in texts:
            if not t:
                out.append(join([]))
            elif self.special is not None and self.special.search(t):
                out.append(join([self.encoded(t)]))
            else:
                parts = cut(t)
                first = parts[0]
                # A text that starts with the cut space has an empty first part.
                out.append(join(chain([self.encoded(first)] if first else [], map(known, islice(parts, 1, None)))))
        return out


def id_bytes(ids: list[int]) -> bytes:
    """Token ids as little-endian unsigned 32-bit integers."""
    a = array("I", ids)
    if a.itemsize != 4:  # pragma: no cover - no such platform is supported
        raise RuntimeError("needs 4-byte unsigned int")
    if sys.byteorder == "big":  # pragma: no cover
        a.byteswap()
    return a.tobytes()


class IdEncoder:
    """Token ids of whole texts, as bytes, equal to those of the ``tokenizers`` file.

    The file's merges are handed to the quicker rank encoder where they are plain byte-level
    ranks (ids in merge order); a probe that differs, an added string, or a text with runs
    that its pattern matcher may not bear goes to the library itself.
    """

    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    PROBE = "It's  probed\n\n by 3 lines, isn't it? \t \u00e9\u00df\u4e2d\U0001f600 x\u00a0y 12a--b..\r\n end "

    def __init__(self, path: str):
        self.tok, self.special = load(path)
        self.quick = self._ranks(path)
        if self.quick is not None and self.quick.encode_ordinary(self.PROBE) != self._library(self.PROBE):
            self.quick = None

    def _library(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _ranks(path: str):
        import json

        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if (spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex", True) or model.get("type") != "BPE"):
            return None
        # The printable stand-ins of byte-level BPE: bytes without a visible character of their own follow from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        stand_in = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        added = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(stand_in[ch] for ch in w): i for w, i in model["vocab"].items() if w not in added}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged):
            return None
        return tiktoken.Encoding("from-file", pat_str=IdEncoder.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        # Hardly any spaces: some run is long.
        odd = len(text) > 5_000 + 50 * text.count(" ")
        if self.quick is None or odd or self.special is not None and self.special.search(text):
            return id_bytes(self._library(text))
        try:
            return id_bytes(self.quick.encode_ordinary(text))
        except BaseException as e:  # a panic of the pattern matcher is no Exception
            if isinstance(e, KeyboardInterrupt | SystemExit | MemoryError | GeneratorExit):
                raise
            return id_bytes(self._library(text))
