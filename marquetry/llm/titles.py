"""Normal forms of work titles, dates, people and companies for matching catalogues."""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable
from dataclasses import dataclass

from marquetry.llm.names import name_roots, plain_letters, repaired, skeleton

# Marks that bookings put before and after a title.
BEFORE = re.compile(r"^(?:\s*(?:[A-Z0-9]{2,5}\s*-\s+|(?:3D|2D|GC|IMAX|4DX|HFR|VIP)\b\s*-?\s*))+")
AFTER = re.compile(r"(?:\s*(?:\([^()]*\)|\[[^\[\]]*\]|-\s*(?:gala|q\s*&\s*a|70mm|35mm|preview|premiere|imax|3d|sub|dub)|4k(?: restoration)?|restored|preview|advance screening|re-?release))+\s*$", re.I)
# Articles that move or vanish.
ARTICLES = {"the", "a", "an", "le", "la", "les", "el", "il", "das", "der", "die", "den", "los", "las"}
NUMERALS = {"ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "2": 2, "3": 3, "4": 4, "5": 5, "6": 6, "7": 7, "8": 8, "9": 9, "two": 2, "three": 3, "four": 4, "five": 5}
DIGITS = {"2": "two", "3": "three", "4": "four", "5": "five", "6": "six", "7": "seven", "8": "eight", "9": "nine", "10": "ten", "12": "twelve"}
# Endings that name a sequel or offshoot.
SEQUELS = re.compile(r"[\s:,-]+(?:(?:part|chapter|volume|vol\.?)\s+(two|three|four|five|ii|iii|iv|v|\d)|(origins|(?:the )?final chapter|director'?s notes|returns|the return|the beginning|reloaded|resurrection|the next generation|legacy|reborn)|(ii|iii|iv|vi|[2-9]))\s*$", re.I)
# Last words without which the patterns above can't match; they spare most titles the search.
_NOISE_ENDS = {"gala", "a", "70mm", "35mm", "preview", "premiere", "imax", "3d", "sub", "dub", "4k", "restoration", "restored", "screening", "release", "rerelease"}
_SEQUEL_ENDS = {"two", "three", "four", "five", "ii", "iii", "iv", "v", "vi", "origins", "chapter", "notes", "returns", "return", "beginning", "reloaded", "resurrection", "generation", "legacy", "reborn"}
_LAST = re.compile(r"([^\W_]+)\W*$")
_MOVED = re.compile(r"^(.*),\s*(the|a|an|le|la|les|el|il|das|der|die|den)$")
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Title:
    """text: the words without noise, articles and sequel marks run together after the folds; words; sequel: its marks."""

    text: str
    words: tuple[str, ...]
    sequel: str


def _last_word(text: str) -> str:
    """The letters and digits that only other marks follow, as by `_LAST`."""
    word = text[text.rfind(" ") + 1 :]
    if word.isalnum():
        return word
    last = _LAST.search(text)
    return last.group(1) if last else ""


def strip_noise(title: str) -> str:
    """A title without booking marks before and after it; a title that is nothing but marks stays."""
    t = " ".join(repaired(title).split())
    before = BEFORE.match(t)
    out = t[before.end() :] if before else t
    if out[-1:] in ")]" or ((last := _last_word(out)) and (last.lower() in _NOISE_ENDS or "&" in out[-6:])):
        out = AFTER.sub("", out)
    return out.strip(" -:") or t


def title_words(title: str | None) -> tuple[tuple[str, ...], str] | None:
    """The words of a title and its sequel marks; null for a missing one or one without words."""
    if title is None or not title.strip():
        return None
    t = plain_letters(strip_noise(title)).replace("&", " and ")
    if "," in t:
        t = _MOVED.sub(r"\2 \1", t)
    marks = []
    while ((last := _last_word(t)) in _SEQUEL_ENDS or last.isdigit()) and (m := SEQUELS.search(t)) and m.start() > 0:
        number = (m.group(1) or m.group(3) or "").lower()
        marks.append(str(NUMERALS.get(number, number)) if number else skeleton(m.group(2).removeprefix("the ")))
        t = t[: m.start()]
    words = tuple(w for w in _WORD.findall(t.replace("'", "")) if w not in ARTICLES) or tuple(_WORD.findall(t))
    return (tuple([DIGITS.get(w, w) for w in words]), "/".join(reversed(marks))) if words else None


def title_form(title: str | None) -> Title | None:
    """The form of a title; null for a missing one or one without words."""
    found = title_words(title)
    if found is None:
        return None
    whole = "".join(found[0])
    return Title(skeleton(whole) or whole, *found)


def date_days(text: str | None) -> tuple[int | None, bool]:
    """Days since 1970 of a date written as 2020-01-31, 31/01/2020 or 2020, and whether only the year is known."""
    if not text:
        return None, False
    t = text.strip()
    if m := re.match(r"(\d{4})-(\d\d)-(\d\d)", t):
        y, mo, d = map(int, m.groups())
    elif m := re.match(r"(\d\d?)[/.](\d\d?)[/.](\d{4})", t):
        d, mo, y = map(int, m.groups())
        if mo > 12 >= d:
            d, mo = mo, d
    elif m := re.match(r"(\d{4})$", t):
        return (datetime.date(int(t), 7, 1) - datetime.date(1970, 1, 1)).days if int(t) else None, True
    else:
        return None, False
    try:
        return (datetime.date(y, mo, d) - datetime.date(1970, 1, 1)).days, False
    except ValueError:
        return None, False


_BETWEEN = re.compile(r"[|;\n\t/•]+|\s&\s|\sand\s")
_MARKS = re.compile(r"[|;\n\t/•&\[]|\sand\s")
_LISTED = re.compile(r"\"([^\"]+)\"|'([^']+)'")
_OUTSIDE = re.compile(r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
_NOBODY = {"n/a", "tba", "unknown", "various", "-"}


def split_people(text: str | None) -> list[str]:
    """Names packed in one text: bars, semicolons, slashes, lines, JSON lists; commas between full names."""
    if not text:
        return []
    t = text.strip()
    if t.startswith("["):
        return [x for x in _LISTED.findall(t) for x in x if x]
    parts = _BETWEEN.split(t) if _MARKS.search(t) else [t]
    if len(parts) == 1 and "," in t:
        pieces = [p.strip(' "') for p in _OUTSIDE.split(t)]
        if all(" " in p for p in pieces):
            parts = pieces
    return [q for p in parts if (q := p.strip(' "'))]


def people_roots(text: str | None) -> list[tuple[list[str], str, list[str]]]:
    """Each person named as in `name_roots`."""
    return [name_roots(p) for p in split_people(text) if p.lower() not in _NOBODY]


def folded_keys(roots: list[tuple[list[str], str, list[str]]], fold: Callable[[str], str] = skeleton) -> list[str]:
    """The keys of `people_keys` from `people_roots`."""
    out = set()
    for whole, family, letters in roots:
        out.update([f"={k}" for x in whole if (k := fold(x)) or letters])
        if letters and (k := fold(family)):
            out.update([f"{x}.{k}" for x in letters])
    return sorted(out)


def people_keys(text: str | None) -> list[str]:
    """For each person named: the full spelling, or initial and family name, as `initial.family` and `=full`."""
    return folded_keys(people_roots(text))


# Words of company names that vary in writing.
COMPANY_WORDS = {"prods": "productions", "prod": "productions", "pics": "pictures", "ent": "entertainment", "co": "company", "distrib": "distribution", "intl": "international"}
COMPANY_ENDS = {"ltd", "inc", "llc", "gmbh", "sa", "pty", "plc", "corp"}


def company_key(name: str | None) -> str | None:
    """A company's name in one manner of writing."""
    if not name:
        return None
    words = [COMPANY_WORDS.get(w, w) for w in re.findall(r"[^\W_]+", plain_letters(name)) if w not in COMPANY_ENDS]
    return " ".join(words) or None
