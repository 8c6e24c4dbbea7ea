"""Words as they are compared between texts: case, accents, ligatures, markup signs and spacing do not count."""

from __future__ import annotations

import re
import unicodedata
from hashlib import blake2b

import numpy as np

# fixed values: letters that no decomposition reduces to a base letter
_BASE = str.maketrans({
    "ø": "o", "đ": "d", "ð": "d", "ł": "l", "ħ": "h", "ı": "i", "ŧ": "t", "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ŋ": "n", "ſ": "s",
})
# fixed values: signs of light markup; they vanish, while other punctuation separates words
_MARKUP = dict.fromkeys(map(ord, "*_`~^#"))
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,200}>")
_CJK = "぀-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_CJK}]|[^\W_{_CJK}]+")
CJK_WORD = re.compile(rf"[{_CJK}]")
_SPLIT_MARKS = "゙゚"


class _Folding(dict):
    """What each character becomes, found when it first occurs."""

    def __missing__(self, code: int) -> str:
        out = unicodedata.normalize("NFKD", chr(code).casefold()).translate(_BASE)
        out = "".join(c for c in out if c in _SPLIT_MARKS or unicodedata.category(c) not in ("Mn", "Mc", "Me", "Cf"))
        self[code] = out = unicodedata.normalize("NFC", out) if len(out) > 1 else out
        return out


_FOLDED = _Folding(_MARKUP)


def folded(text: str) -> str:
    """The text without case, accents, ligatures, markup signs and format characters."""
    out = (_TAG.sub("", text) if "<" in text else text).translate(_FOLDED)
    return unicodedata.normalize("NFC", out) if any(m in out for m in _SPLIT_MARKS) else out


def words(text: str | None) -> list[str]:
    """The words of a text: runs of letters and digits; in Chinese and Japanese each character."""
    return _WORD.findall(folded(text)) if text else []


class Hasher:
    """64-bit hashes of words that are the same on every machine; known ones are kept up to a bound."""

    def __init__(self, bound: int = 500_000) -> None:
        self.known: dict[str, int] = {}
        self.bound = bound

    def __call__(self, found: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.bound:
            known.clear()
        for w in found:
            if w not in known:
                known[w] = int.from_bytes(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return np.fromiter((known[w] for w in found), np.uint64, len(found))
