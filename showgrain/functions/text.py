"""Characters: look-alikes, widths, invisible marks, and the tables made of them.

``FOLD`` is one ``str.translate`` table; ``fold_text`` is the Python form of the
consistent form.  The embedded SQL of the look-alike operator is built from the same
tables, so both agree.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# --- fixed values -----------------------------------------------------------------
#: Letters of other scripts, and the Latin letters they look like.
LOOK_ALIKES = {
    # Cyrillic, small
    "а": "a", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "п": "n", "о": "o", "р": "p",
    "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "с": "c", "м": "m", "в": "b", "н": "h",
    "ё": "ë", "ї": "ï",
    # Cyrillic, capital
    "А": "A", "В": "B", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "С": "C",
    "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "З": "3", "Ԛ": "Q", "Ԝ": "W", "Ѵ": "V", "Ӏ": "I", "Ё": "Ë", "Ї": "Ï",
    # Greek, small
    "α": "a", "ϲ": "c", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "η": "n", "ω": "w",
    "ό": "ó", "ά": "á", "ί": "í", "ϳ": "j",
    # Greek, capital
    "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ζ": "Z",
    # others
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "ı": "i", "ɡ": "g", "ɑ": "a", "ʟ": "L", "ⅼ": "l",
}
#: Code points that show nothing: joiners, marks of direction, soft hyphen, variation selectors.
INVISIBLE_RANGES = [(0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xE0001, 0xE007F)]
#: Blanks other than the plain one.
BLANKS = "\t\x0b\x0c\x85\xa0              　  "
# ----------------------------------------------------------------------------------

#: Blocks whose characters are other forms of plain ones: super- and subscripts, letter-like
#: signs, number forms, circled letters, CJK compatibility, mathematical letters, ligatures, widths.
COMPATIBILITY_BLOCKS = [(0x00AA, 0x00BE), (0x0132, 0x0133), (0x01C4, 0x01CC), (0x02B0, 0x02B8), (0x2026, 0x2026), (0x2070, 0x209C), (0x2100, 0x214F), (0x2160, 0x217F), (0x2460, 0x24EA), (0x3300, 0x33FF), (0xFB00, 0xFB06), (0xFF01, 0xFF9F), (0xFFE0, 0xFFE6), (0x1D400, 0x1D7FF)]


@lru_cache(maxsize=1)
def compatibility_forms() -> dict[str, str]:
    """Every character of those blocks with its plain form, by the Unicode rule."""
    out = {}
    for lo, hi in COMPATIBILITY_BLOCKS:
        for code in range(lo, hi + 1):
            c = chr(code)
            plain = unicodedata.normalize("NFKC", c)
            if plain != c and not plain.startswith(" ") and unicodedata.category(c) != "Cn":
                out[c] = plain
    return out


def invisible_class() -> str:
    """The invisible characters as the inside of a regular-expression class."""
    return "".join(rf"\x{{{a:X}}}" if a == b else rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in INVISIBLE_RANGES)


@lru_cache(maxsize=1)
def _fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {ord(c): p for c, p in compatibility_forms().items()}
    table |= {ord(c): p for c, p in LOOK_ALIKES.items()}
    table |= {ord(c): " " for c in BLANKS}
    for a, b in INVISIBLE_RANGES:
        table |= dict.fromkeys(range(a, b + 1))
    return table


def fold_text(text: str) -> str:
    """One form for all strings that look the same: case, accents and wording stay."""
    if text.isascii():
        return text.strip()
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).translate(_fold_table())).strip()


def mixed_script_fold(text: str) -> str:
    """``fold_text`` for words that hold Latin letters; whole words of another script stay."""
    if text.isascii():
        return text
    plain = unicodedata.normalize("NFC", text).translate(_width_table())
    if plain.isascii() or not _ALIKE.search(plain):
        return plain
    return unicodedata.normalize("NFC", _LETTERS.sub(_latin_word, plain))


_LETTERS = re.compile(r"[^\W\d_]+")
_ALIKE = re.compile("[" + "".join(LOOK_ALIKES) + "]")
_PLAIN_LETTER = re.compile("[A-Za-z]")


def _latin_word(m: re.Match) -> str:
    w = m[0]
    return w if w.isascii() or not _PLAIN_LETTER.search(w) and _own_script(w) else w.translate(_fold_table())


@lru_cache(maxsize=1)
def _width_table() -> dict[int, str | None]:
    return {k: v for k, v in _fold_table().items() if k not in _alike_codes()}


@lru_cache(maxsize=1)
def _alike_codes() -> frozenset[int]:
    return frozenset(map(ord, LOOK_ALIKES))


def _own_script(word: str) -> bool:
    """True where a word has a letter that no Latin one looks like, so is not disguised Latin."""
    return any(ord(c) > 0x24F and c not in LOOK_ALIKES for c in word)


def bare(text: str) -> str:
    """Lower case without accents, for comparing words."""
    d = unicodedata.normalize("NFD", mixed_script_fold(text).lower())
    return "".join(c for c in d if not unicodedata.combining(c))
