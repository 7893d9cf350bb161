"""Statistics of a text that tell prose from lists, tables and junk: numbers per document, no verdict."""

from __future__ import annotations

import re
from collections import Counter

#: Function words of the corpus languages, without those that also join names (and, with, y, o, ...).
FUNCTION_WORDS = frozenset(
    """the of to in for on by at from was were is are be been has had have that this which it its as or not but when while who after before until than then there these
    those their they he she his her we you i so if no any all may will would should could must can did do does under over into within because although yet one some each
    per our us an
    de la el los las en que se por un una para con del al su es fue son lo como más sus le ha han este esta
    के है में की को से का और पर ने एक यह भी हैं था थी थे नहीं कि जो तो ही कर लिए गया गई गए इस उस द्वारा तक ये वह हो या दिया लिया किया""".split()
)
#: Words of site navigation.
NAVIGATION = frozenset(
    """login logout help search sitemap print next previous gallery share feedback contact faq home archive about us circulars tenders careers skip to content screen reader
    menu back top english hindi register subscribe rss terms privacy policy copyright loading please wait page not found click here for more""".split()
)

#: The statistics, in the order shape() gives them.
SHAPE = (
    "n_lines", "words_a_line", "short_lines", "flowing_lines", "marked_lines", "ended_lines", "regular_lines", "distinct_lines",
    "common_words", "navigation_words", "distinct_words", "mean_word_length", "odd_words", "long_tokens", "symbol_ratio", "digit_ratio", "separators",
)

_MARK = re.compile(r"\s*(?:[-*•·–—▪]\s|o\s|\(?(?:\d{1,4}|[a-z]{1,3}|[ivxlc]{1,6})[.)]\s)", re.I)
_GAPS = re.compile(r" {2,}")
_ROW = re.compile(r"<t[rdh]\b", re.I)
_VOWEL = re.compile(r"[aeiouyáéíóúüñ\dऀ-෿]")
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~“”‘’•·–—…।"
_SEPARATORS = ";,|/+•·\t"

class _Odd(dict):
    """Word -> whether it has no vowel, or letters mixed with digits or symbols inside. Remembered, as words repeat."""

    def __missing__(self, word: str) -> bool:
        if len(self) > 200_000:
            self.clear()
        bare = word.strip(_PUNCTUATION)
        odd = self[word] = not _VOWEL.search(bare) or not (bare.isalpha() or bare.isdigit() or bare.replace("-", "").replace("'", "").isalpha())
        return odd


_ODD = _Odd()


def cells(line: str) -> tuple[str, int]:
    """What parts the cells of a line, and their number: three at least, else ('', 1)."""
    if "<" in line and _ROW.search(line):
        return "t", max(3, line.lower().count("<td") + line.lower().count("<th"))
    for mark in "\t|":
        n = line.count(mark)
        if n >= 2:
            return mark, n + 1
    n = len(_GAPS.findall(line.strip())) if "   " in line or line.count("  ") >= 2 else 0
    if n >= 2:
        return " ", n + 1
    n = line.count(",")
    return (",", n + 1) if n >= 2 else ("", 1)


def shape(text: str) -> list[float]:
    """SHAPE of a text, read whole; shares of lines are weighed by their characters. A text without words has zeros.

    Ratios come in thousandths and counts with three digits, which is what their ranks are exact for.
    """
    lines = [(x, s) for x in text.splitlines() if (s := x.strip())]
    if not lines:
        return [0.0] * len(SHAPE)
    size = short = flowing = marked = ended = 0
    words: list[str] = []
    common = 0
    forms: Counter[tuple[str, int]] = Counter()
    for line, s in lines:
        n = len(s)
        mine = s.lower().split()
        known = sum(map(FUNCTION_WORDS.__contains__, mine))
        words += mine
        common += known
        size += n
        short += n * (len(mine) <= 8)
        flowing += n * (known >= 0.12 * len(mine))
        marked += n * (_MARK.match(line) is not None)
        ended += s[-1] in ".!?।"
        form = cells(line)
        if form[1] > 1:
            forms[form] += n
    n, most = len(words), max(forms.values(), default=0)
    sizes = list(map(len, words))
    ink = sum(sizes)
    symbols = sum(map(text.count, _PUNCTUATION))
    digits = sum(map(text.count, "0123456789"))
    ratio = lambda a, b: round(a / b, 3) if b else 0.0
    count = lambda x: float(f"{x:.3g}")
    return [
        count(len(lines)), count(n / len(lines)), ratio(short, size), ratio(flowing, size), ratio(marked, size), ratio(ended, len(lines)), ratio(most, size), ratio(len({s for _, s in lines}), len(lines)),
        ratio(common, n), ratio(sum(map(NAVIGATION.__contains__, words)), n), ratio(len(set(words)), n), count(ink / n),
        ratio(sum(map(_ODD.__getitem__, words)), n), ratio(sum(x for x in sizes if x >= 30), ink), ratio(symbols, ink), ratio(digits, ink), count(sum(map(text.count, _SEPARATORS)) / n),
    ]
