"""Normal forms of personal names: what survives typing habits, and edit distance. Plain functions used in Arrow batches."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Full given names and the short forms they go by; one short form may stand for several names. A short
# form with -y, -ie or -i after it (its last letter doubled or not) goes by the same entry, see `full_names`.
SHORT_FORMS = {
    "abigail": "abby gail", "albert": "al bert", "alexander": "alex sasha xander sandy", "alexandra": "alex sasha sandra", "alfred": "alf fred", "andrew": "andy drew",
    "aniruddha": "ani", "anthony": "tony", "augustus": "gus", "beatrix": "bea trixie", "benedict": "ben", "benjamin": "ben benji", "cassandra": "cass sandra",
    "charles": "charlie chuck", "charlotte": "charlie lottie", "chidinma": "chichi chidi", "christine": "chris tina", "christopher": "chris kit", "constance": "connie",
    "cornelius": "neil cory connie", "daniel": "dan", "david": "dave", "desmond": "des dez", "dimitri": "dima mitya", "donald": "don", "dorothea": "dot dora thea",
    "edmund": "ed ned", "edward": "ed ned ted", "eleanor": "nell", "elizabeth": "liz beth betty eliza bess", "evangeline": "eve evie eva", "ferdinand": "ferd nando",
    "frederick": "fred rick", "gabriel": "gabe", "gerald": "jerry", "gilbert": "bert gil", "gregory": "greg", "gwendolyn": "gwen", "harold": "harry hal",
    "henrietta": "hattie etta hetty", "henry": "harry hank hal", "herbert": "bert herb", "hubert": "bert", "imogen": "immy", "isabella": "izzy bella isa",
    "james": "jim", "jeremy": "jerry", "joanna": "jo", "john": "jack", "jonathan": "jon nathan jonty", "jose": "pepe", "joseph": "joe", "josephine": "josie jo",
    "katherine": "kate kath katie kit", "kenneth": "ken", "kwabena": "kwab", "lakshmi": "lucky", "lawrence": "larry", "leonard": "len leo", "lucinda": "lucy cindy lulu",
    "ludmila": "mila lyuda", "margaret": "maggie peggy meg greta", "mary": "molly polly", "matthew": "matt", "michael": "mike mick mickey misha", "montgomery": "monty",
    "natalie": "nat", "nathaniel": "nate nat", "nicholas": "nick nico klaus", "nicola": "nick", "olumide": "olu", "ottilie": "tilly", "patricia": "pat tricia trish",
    "patrick": "pat", "penelope": "penny nell", "percival": "percy", "peter": "pete", "philip": "phil", "philippa": "pippa pip", "priyanka": "pri", "quentin": "quin quint",
    "rajendra": "raj", "raphael": "rafe rafa raf", "raymond": "ray", "richard": "dick rich rick", "robert": "bob rob bert", "ronald": "ron", "rosalind": "roz ros rosie",
    "samantha": "sam", "samuel": "sam", "sebastian": "seb bastian", "stephen": "steve", "tabitha": "tabby", "theodore": "theo ted", "thomas": "tom", "timothy": "tim",
    "valentina": "val tina", "valerie": "val", "venkatesh": "venky venkat", "victor": "vic", "victoria": "vicky tori vic", "vladislav": "vlad", "walter": "walt",
    "wilfred": "will fred", "wilhelmina": "mina willa billie", "william": "bill will liam", "xavier": "xavi", "yevgenia": "zhenya", "zachary": "zack zach zak",
}
# Titles before and generation marks after a name; they name nobody.
TITLES = {"dr", "mr", "mrs", "ms", "miss", "sir", "dame", "prof", "lord", "lady"}
SUFFIXES = {"jr", "sr", "ii", "iii", "iv", "phd", "esq"}
# Words that belong to the family name after them.
PARTICLES = {"van", "von", "der", "den", "de", "la", "le", "del", "di", "da", "al", "el", "bin", "st", "mac", "mc", "o", "ter", "ten"}
# Letters that look or sound alike, applied in this order.
FOLDS = [("0", "o"), ("1", "l"), ("5", "s"), ("3", "e"), ("sch", "sh"), ("ph", "f"), ("ck", "k"), ("c", "k"), ("q", "k"), ("oo", "u"), ("ou", "u"), ("y", "i"), ("w", "v"), ("th", "t"), ("z", "s"), ("ae", "a"), ("oe", "o"), ("ue", "u")]
_BRACKETS = re.compile(r"\([^)]*\)|\[[^\]]*\]")
_NICKNAME = re.compile(r"(?<!\w)[\"“”'‘’][^\"“”'‘’]+[\"“”'‘’](?!\w)")
_SUFFIX = re.compile(r",?\s*\b(" + "|".join(SUFFIXES) + r")\b\.?\s*$")
_APOSTROPHE, _NO_NAME = re.compile(r"['’`]\s*"), re.compile(r"[^\w-]")
_NO_LETTER, _TWICE = re.compile(r"[^a-z]"), re.compile(r"(.)\1+")
_DIGITS = str.maketrans("0153", "olse")
_DASHES = re.compile(r"[-‐-―]")


def repaired(text: str) -> str:
    """UTF-8 that was once read as Latin-1, read right."""
    if "Ã" in text or "Â" in text:
        for code in ("cp1252", "latin-1"):
            try:
                return text.encode(code).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
    return text


def plain_letters(text: str) -> str:
    """Lower case without accents."""
    if text.isascii():
        return text.lower()
    text = text.replace("ø", "o").replace("Ø", "O").replace("ł", "l").replace("ß", "ss").replace("æ", "ae").replace("đ", "d")
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def skeleton(word: str) -> str:
    """Letters after the folds, runs of one letter made single, and a silent final e dropped."""
    for a, b in FOLDS:
        if a in word:
            word = word.replace(a, b)
    word = _TWICE.sub(r"\1", _NO_LETTER.sub("", word))
    return word[:-1] if len(word) > 4 and word.endswith("e") else word


def skeletons(words: list[str]) -> list[str]:
    """`skeleton` of each word, all at once."""
    folded = pa.array(words, pa.string())
    for a, b in FOLDS:
        folded = pc.replace_substring(folded, a, b)
    if not (size := pc.binary_length(folded).to_numpy(zero_copy_only=False)).sum():
        return words
    letter = np.frombuffer(folded.buffers()[2], np.uint8)[: size.sum()]
    row = np.repeat(np.arange(len(words)), size)
    plain = (letter >= ord("a")) & (letter <= ord("z"))
    letter, row = letter[plain], row[plain]
    new = np.append(True, (letter[1:] != letter[:-1]) | (row[1:] != row[:-1]))[: len(row)]
    letter, row = letter[new], row[new]
    size = np.bincount(row, minlength=len(words))
    last = np.cumsum(size)[size > 4] - 1
    silent = last[letter[last] == ord("e")]
    size[row[silent]] -= 1
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(words), pa.py_buffer(ends), pa.py_buffer(np.delete(letter, silent))).to_pylist()


def parse_name(name: str | None) -> tuple[list[str], bool]:
    """The words of a name in the order given names, family name, and whether a comma told that order.

    Titles, generation marks, remarks in brackets and quoted nicknames are left out.
    """
    text = repaired(name or "")
    if "(" in text or "[" in text:
        text = _BRACKETS.sub(" ", text)
    if not text.isascii() or "'" in text or '"' in text:
        text = _NICKNAME.sub(" ", text)
    text = plain_letters(text)
    if text.rstrip(" .").endswith(tuple(SUFFIXES)):
        text = _SUFFIX.sub("", text)
    family, comma, given = text.partition(",")
    if comma and given.strip():
        text = f"{given} {family}"
    if "'" in text or "’" in text or "`" in text:
        text = _APOSTROPHE.sub("", text)
    words = []
    for w in text.replace(".", ". ").split():
        if w.isalpha():
            if words or w not in TITLES:
                words.append(w)
            continue
        w = _DASHES.sub("-", w).strip("-")
        bare = _NO_NAME.sub("", w)
        if bare.strip("-") and not (w.rstrip(".") in TITLES and not words):
            words.append(bare)
    return words, bool(comma and given.strip())


_DIMINUTIVE = re.compile(r"(?:ie|y|i)$")


def _stems(word: str) -> list[str]:
    """A short form without its diminutive ending, and with the letter before it single; none without such an ending."""
    stem = _DIMINUTIVE.sub("", word)
    if stem == word or len(stem) < 2:
        return []
    return [stem, stem[:-1]] if stem[-1] == stem[-2] else [stem]


def by_short_form(full: dict[str, str]) -> dict[str, list[str]]:
    """The full names that each short form stands for, from full names with their short forms. Stems of diminutives
    are entered with a mark before them, as only other diminutives of the stem stand for the name too."""
    out: dict[str, list[str]] = {}
    for name, shorts in full.items():
        for s in shorts.split():
            for k in dict.fromkeys([s, f"-{s}", *(f"-{x}" for x in _stems(s))]):
                if name not in out.setdefault(k, []):
                    out[k].append(name)
    return out


ALIASES = by_short_form(SHORT_FORMS)


def full_names(word: str, aliases: dict[str, list[str]] = ALIASES) -> list[str]:
    """The full given names that `word` may be short for; itself if it is no known short form."""
    word = word.translate(_DIGITS)
    if word in aliases:
        return aliases[word]
    return next((aliases[f"-{s}"] for s in _stems(word) if f"-{s}" in aliases), [word])


@dataclass(frozen=True)
class Form:
    """What blocking and comparison use of one written name.

    spelling: skeleton of given and family name run together, letters unfolded in plain; keys: skeletons under which the same name may also be
    written (words swapped, gaps moved, middle names counted in); soft: letters unfolded of the names it may stand for if
    the given name is short for several; family: skeleton of the family name; initial: the given name's first letter if it is
    only an initial; letters: first letters by which the given name may be abbreviated; middles: initials of the middle names.
    """

    spelling: str
    plain: str
    keys: list[str]
    soft: list[str]
    family: str
    initial: str | None
    letters: list[str]
    middles: list[str]


def _parts(name: str | None) -> tuple[list[str], int]:
    """The words of a name, given names first, and where the family name begins."""
    words, _ = parse_name(name)
    if len(words) > 1 and len(words[-1]) == 1 and len(words[0]) > 1:  # family name first, then an initial
        cut = next(i for i in range(len(words)) if len(words[i]) == 1)
        words = words[cut:] + words[:cut]
    at = len(words) - 1
    while at > 1 and words[at - 1] in PARTICLES:
        at -= 1
    return words, at


def name_roots(name: str | None) -> tuple[list[str], str, list[str]]:
    """Spellings (none for an initial; one for each name that the given one may be short for), family name, and letters,
    as in `name_form` but before the folds and without the rest; a single word has no family name and no letters."""
    words, at = _parts(name)
    if len(words) < 2:
        return words, "", []
    given, family = words[0], "".join(words[at:])
    if len(given) == 1:
        return [], family, [given]
    roots = full_names(given)
    return [r + family for r in roots], family, sorted({given[0], *(r[0] for r in roots)})


def name_form(name: str | None, aliases: dict[str, list[str]] = ALIASES) -> Form:
    """The form of a written name; an empty or missing name has an empty spelling."""
    words, at = _parts(name)
    if not words:
        return Form("", "", [], [], "", None, [], [])
    if len(words) == 1:
        whole = skeleton(words[0])
        return Form(whole, words[0].replace("-", "").translate(_DIGITS), [whole], [], "", None, [], [])
    given, middle, family = words[0], words[1:at], "".join(words[at:])
    middles = sorted({w[0] for w in middle})
    if len(given) == 1:
        return Form("", "", [], [], skeleton(family), given, [given], middles)
    roots = full_names(given, aliases)
    root = roots[0] if len(roots) == 1 else given  # short for several names, it stands as it is written
    turned = full_names(family, aliases)
    whole = skeleton(root + family)
    keys = {whole, skeleton((turned[0] if len(turned) == 1 else family) + given), skeleton(root + "".join(words[1:]))}
    if middle:  # a gap within a given name of two parts
        keys.add(skeleton("".join(words)))
    plain = (root + family).replace("-", "").translate(_DIGITS)
    soft = [(r + family).replace("-", "").translate(_DIGITS) for r in roots] if len(roots) > 1 else []
    return Form(whole, plain, sorted(keys), soft, skeleton(family), None, sorted({given[0], *(r[0] for r in roots)}), middles)


def edits(a: str, b: str, most: int = 2) -> int:
    """Optimal string alignment distance (a swap of neighbours is one edit), or most + 1 if it is more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and i > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        if min(now) > most:
            return most + 1
        before, last = last, now
    return last[-1]
