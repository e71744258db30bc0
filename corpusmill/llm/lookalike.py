"""Characters that print alike.

`fold` brings a text into the form in which two texts that look the same in print are equal: spaces of like width
become a space, invisible characters go, wide forms, ligatures and split accents are joined, kinds of hyphen become `-`
and letters borrowed from Greek or Cyrillic become the Latin letter they look like. Digits, letter case, signs, accents
and raised figures stay as they are.
"""

from __future__ import annotations

import re
import unicodedata

# Unicode characters by the way they print.
SPACES = "\u00a0\u1680\u2000\u2002\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
INVISIBLE = "\u00ad\u034f\u061c\u115f\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufe0e\ufe0f\ufeff"
HYPHENS = "\u2010\u2011\ufe63\uff0d"
CYRILLIC = {
    "\u0410": "A", "\u0412": "B", "\u0415": "E", "\u041a": "K", "\u041c": "M", "\u041d": "H", "\u041e": "O", "\u0420": "P", "\u0421": "C", "\u0422": "T", "\u0423": "Y", "\u0425": "X", "\u0405": "S", "\u0406": "I", "\u0408": "J", "\u04ae": "Y",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l",
}
GREEK = {
    "\u0391": "A", "\u0392": "B", "\u0395": "E", "\u0396": "Z", "\u0397": "H", "\u0399": "I", "\u039a": "K", "\u039c": "M", "\u039d": "N", "\u039f": "O", "\u03a1": "P", "\u03a4": "T", "\u03a5": "Y", "\u03a7": "X", "\u03bf": "o", "\u03f2": "c", "\u03f3": "j",
}
OTHER = {"\u0131": "\u0131", "\u212a": "K", "\u212b": "\u00c5", "\u02bc": "\u2019", "\u0131\u0307": "i"}
LIGATURES = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0xFB00, 0xFB07)}
WIDE = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0xFF01, 0xFF5F)}

TABLE = (
    {ord(c): " " for c in SPACES}
    | {ord(c): None for c in INVISIBLE}
    | {ord(c): "-" for c in HYPHENS}
    | {ord(k): v for k, v in (CYRILLIC | GREEK | LIGATURES).items()}
    | {ord(k): v for k, v in WIDE.items() if k != "－"}
    | {ord(k): v for k, v in OTHER.items() if len(k) == 1 and k != v}
)
MARKS = "\u0300-\u036f"

#: A character class (for Java and Python alike) of everything that `fold` may change.
SUSPECT_CLASS = (
    "["
    + SPACES + INVISIBLE + HYPHENS + "".join(CYRILLIC) + "".join(GREEK)
    + "\u212a\u212b\u02bc\ufb00-\ufb06\uff01-\uff5e\u1e00-\u1eff" + MARKS
    + "\u0340-\u0344\u0374\u037e\u0387\u0958-\u095f\u0929\u0931\u0934"
    + "]"
)
_SUSPECT = re.compile(SUSPECT_CLASS)
_OTHER_SCRIPT = re.compile("[\u0370-\u052f]")
_MIXED = re.compile("[A-Za-z][\u0370-\u052f]|[\u0370-\u052f][A-Za-z]")


def suspect(text: str) -> bool:
    """Whether `fold` could change the text, or letters of two scripts stand side by side in it."""
    if text.isascii():
        return False
    if _SUSPECT.search(text) is not None or (_OTHER_SCRIPT.search(text) is not None and _MIXED.search(text) is not None):
        return True
    return not unicodedata.is_normalized("NFC", text)


def _folded(text: str) -> str:
    text = text.translate(TABLE)
    return unicodedata.normalize("NFC", text).translate(TABLE) if not unicodedata.is_normalized("NFC", text) else text


class _Folded(dict):
    """Short pieces and their folded form; it only saves work."""

    def __missing__(self, piece: str) -> str:
        new = _folded(piece)
        if len(piece) <= 24:
            if len(self) > 100_000:
                self.clear()
            self[piece] = new
        return new


_PIECE = re.compile("[A-Za-z]?[^\x00-\x7f]+")  # an ASCII letter may carry the accents that follow it
_FOLDED = _Folded()


def fold(text: str) -> str:
    """The form of a text in which equal means looking the same."""
    if text.isascii():
        return text
    return _PIECE.sub(lambda m: _FOLDED[m[0]], text)
