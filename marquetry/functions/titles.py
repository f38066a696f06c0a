"""Booking noise in film titles: cleaning to a fixed point, tagging, known patterns, discovery of new ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquetry.functions.text import col, strip

# The noise rules (pattern, label); languages and formats are part of some.
_LANGUAGES = "hindi|tamil|telugu|english|mandarin|malayalam|kannada|japanese|cantonese|punjabi|gujarati|bengali|subbed|dubbed|subtitled"
_FORMATS = "imax|4k|4dx|screenx|scrnx|70mm|hfr|dolby|atmos"
PREFIX_RULES = [
    (r"^[A-Z]{2,6}\d{0,2}\s*[-–]\s+", "festival_code_prefix"),
    (r"(?i)^3D\s+", "3d_prefix"),
    (r"(?i)^Sci-?\s*Fi\s*[-–]\s+", "sci_fi_series"),
    (r"(?i)^Exhibition\s+On\s+Screen\s*[-–]\s+", "event_series"),
    (r"(?i)^HW\s+Classic\s*[-–]\s+", "event_series"),
    (r"(?i)^French\s+Fridays\s*[-–]\s+", "event_series"),
    (r"(?i)^Sensory\s+Screening\s*[-–]\s+", "event_series"),
    (r"(?i)^Skycity\s*[-–]\s+", "event_series"),
    (r"(?i)^Flickerfest\s*[-–]\s+", "event_series"),
    (r"(?i)^Winda\s*[-–]\s+", "event_series"),
    (r"(?i)^Real\s+FF\s*[-–]\s+", "event_series"),
    (r"(?i)^Cans\s+FF\s*[-–]\s+", "event_series"),
    (r"(?i)^\d{4}\s+Oscar\s+Nominated\s*[-–]\s+", "oscar_shorts"),
]
BRACKET_RULES = [
    (rf"(?i)\s*[\(\[](?:{_LANGUAGES}|[a-z]+ version)[\)\]]\s*$", "language_bracket"),
    (rf"(?i)\s*[\(\[](?:{_FORMATS})[\)\]]\s*$", "format_bracket"),
    (r"(?i)\s*\(3D\)\s*$", "3d_bracket"),
    (r"\s*\(\d{4}\)\s*$", "year_bracket"),
    (r"(?i)\s*[\[\(][a-z]{0,5}ff[a-z]{0,4}\d{0,2}[\]\)]\s*$", "festival_code_bracket"),
    (r"(?i)\s*[\[\(][^\]\)]*\bfilm\s+fest[^\]\)]*[\]\)]\s*$", "festival_name_bracket"),
]
# pattern, label, least length of what stays before it
TRAILING_RULES = [
    (rf"(?i)\s*[-–]\s*(?:{_FORMATS}|\d{{1,2}}K?\s*(?:restoration|remaster(?:ed|ing)?))\s*$", "format_trailing", 0),
    (r"(?i)\s+\d{1}K\s+(?:restoration|remaster(?:ed|ing)?)\s*$", "format_trailing_prefixed", 0),
    (r"(?i)\s*[-–]\s*(?:q\s*[&+]\s*a|sing[- ]along)\s*$", "screening_type_trailing", 0),
    (r"(?i)\s*[-–]\s*(?:gala|preview)\s*$", "screening_type_trailing", 8),
    (r"(?i)\s*[-–]\s*[a-z]{0,5}ff[a-z]{0,3}\d{0,2}\s*$", "festival_code_trailing", 0),
    (r"(?i)\s*[-–]?\s*3D\s*$", "3d_trailing", 0),
]
# Known patterns by tag; a title has a tag if any pattern of it is found in any case.
KNOWN_PATTERNS = {
    "is_3d": [r"\b3d\b"],
    "is_format": [r"\bimax\b", r"\b4dx\b", r"\bscreenx\b", r"\bscrnx\b", r"\b70mm\b", r"\b4k\b", r"\bdolby\b", r"\batmos\b", r"\bhfr\b", r"\brestoration\b"],
    "is_ff_prefix": [
        r"^[a-z]{2,5}\d{0,2}\s*[-–]\s(?!\s)",
        r"^[a-z]{2,5}\s+ff\s*[-–]\s",
        r"^sci[-\s]fi\s*[-–]\s",
        r"^(exhibition\s+on\s+screen|hw\s+classic|french\s+fridays|sensory\s+screening|skycity|flickerfest|winda)\s*[-–]\s",
    ],
    "is_ff_suffix": [r"[-–][a-z]{2,4}ff$", r"\s[a-z]{2,4}ff$"],
    "is_ff_named": [
        r"\bfilm\s+fest", r"\bfilm\s+tour\b", r"\bnziff\b", r"\bkoffia\b", r"\bgcff\b", r"\bstff\b", r"\bradff\b", r"\bslaff\b", r"\bssaff\b", r"\bsiffc\b",
        r"\bsmsff\b", r"\bniaff\b", r"\bcquff\b", r"\banimeff\b", r"\bflickerfest\b", r"\bwinda\b", r"\baff:", r"(?<![a-z])iff(?![a-z])", r"\brff\b", r"\bfff\b",
    ],
    "is_ff_bracket": [r"[\[\(][a-z]{0,5}ff[a-z]{0,4}\d{0,2}[\]\)]", r"[\[\(][^\]\)]*\bfilm\s+fest[^\]\)]*[\]\)]"],
    "is_multi": [r"\+", r"\bplus\b", r"\bmarathon\b", r"\bdouble\s+feature\b", r"\beps?\s*\d", r"\bepisodes?\s*\d"],
    "is_alt_lang": [
        r"[-–\s](hindi|tamil|telugu|mandarin|malayalam|kannada|japanese|cantonese|punjabi|gujarati|bengali|subtitled|dubbed)$",
        r"\((hindi|tamil|telugu|english|mandarin|malayalam|kannada|japanese|cantonese|punjabi|gujarati|bengali|subbed|dubbed|subtitled)\)",
        r"\([a-z]+ version\)",
        r"\bsubtitles?\b",
    ],
    "is_rerelease": [r"\banniversary\b", r"\bremaster(ed)?\b", r"\bdirector'?s\s+cut\b", r"\bextended\s+edition\b", r"\bspecial\s+edition\b", r"\brestored\b", r"\(\d{4}\)"],
    "is_screening_type": [r"\bq\s*[&+]\s*a\b", r"\bsing.along\b", r"\bgala\b", r"\bopening\s+night\b", r"\bclosing\s+night\b", r"\bpreview\b"],
    "is_event": [
        r"\bconcert\b", r"\blive\s+(at|from|in)\b", r"[-–]\s*live$", r"\bopera\b", r"\bballet\b", r"\borchestra\b", r"\bphilharmonic\b",
        r"^(nrl|fifa|world\s+cup|oscar\s+nominated)\b", r"\b(nrl|fifa)\b.*[-–]",
    ],
}
FESTIVAL_TAGS = ["is_ff_prefix", "is_ff_suffix", "is_ff_named", "is_ff_bracket"]
# Words that make a token before a dash prose, not a code.
PROSE = "the a an of in on at to and or is it by be as do for up so if my me we he she his her our its but not with from into".split()
PREFIX_TOKEN = r"^(.{2,25}?)\s*[-–]\s+\S"
BRACKET_TOKEN = r"[\[\(]([^\]\)]{2,25})[\]\)]$"


def _one_pass(t: Column) -> Column:
    rule, *rules = [p for p, _ in PREFIX_RULES]
    out = F.when(t.rlike(rule), strip(F.regexp_replace(t, rule, "")))
    for rule in rules:
        out = out.when(t.rlike(rule), strip(F.regexp_replace(t, rule, "")))
    out = out.otherwise(t)
    for rule, _ in BRACKET_RULES:
        out = strip(F.regexp_replace(out, rule, ""))
    for rule, _, least in TRAILING_RULES:
        cut = strip(F.regexp_replace(out, rule, ""))
        out = F.when(F.char_length(cut) >= least, cut).otherwise(out) if least else cut
    return out


def clean_title(title: Column | str) -> Column:
    """A title without event, festival, format and language noise; rules run until nothing changes. Null stays null; a
    title that is all noise may come out empty.

    A pass that changes a title makes it shorter, so there are no more passes than letters; once one changes nothing
    the rest are skipped.
    """
    t = strip(title)
    noisy = "|".join(f"(?:{rule[0]})" for rule in [*PREFIX_RULES, *BRACKET_RULES, *TRAILING_RULES])
    start = F.struct(t.alias("t"), F.lit(False).alias("done"))

    def one_more(state: Column, _: Column) -> Column:
        after = F.when(~state["done"], _one_pass(state["t"])).otherwise(state["t"])
        return F.struct(after.alias("t"), (state["done"] | (after == state["t"])).alias("done"))

    cleaned = F.aggregate(F.sequence(F.lit(0), F.char_length(t)), start, one_more, lambda s: s["t"])
    # most titles show no mark at all
    return F.when(t.rlike(noisy), cleaned).otherwise(t)


def title_tags(title: Column | str) -> Column:
    """map(label -> text) of the rules that fire on the title as it is; of rules with one label the last one counts."""
    t = strip(title)
    found = [(label, F.regexp_extract(t, rule, 0), t.rlike(rule)) for rule, label in [*PREFIX_RULES, *BRACKET_RULES]]
    for rule, label, least in TRAILING_RULES:
        long = F.char_length(strip(F.regexp_replace(t, rule, ""))) >= least
        found.append((label, F.regexp_extract(t, rule, 0), t.rlike(rule) & long))
    labels = list(dict.fromkeys(label for label, _, _ in found))
    entries = []
    for label in labels:
        last = None
        for name, text, fired in found:
            if name == label:
                last = F.when(fired, strip(text)).otherwise(last) if last is not None else F.when(fired, strip(text))
        entries.append(F.struct(F.lit(label).alias("key"), last.alias("value")))
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


def with_title_flags(df: DataFrame, title: str) -> DataFrame:
    """`df` with a boolean for each tag, is_ff_any, any_tag and n_tags_matched, their number, and matched_by: the first 'tag: pattern' that is found,
    or ''. A null title has no tag."""
    t = col(title)
    found = {tag: F.coalesce(t.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(False)) for tag, patterns in KNOWN_PATTERNS.items()}
    any_of = lambda tags: F.array_contains(F.array(*map(F.col, tags)), True)
    out = df.withColumns(found).withColumns({"is_ff_any": any_of(FESTIVAL_TAGS), "any_tag": any_of(KNOWN_PATTERNS), "n_tags_matched": sum((F.col(tag).cast("int") for tag in KNOWN_PATTERNS), F.lit(0)).cast("bigint")})
    first = F.lit("")
    for tag, patterns in reversed(KNOWN_PATTERNS.items()):
        which = F.coalesce(*(F.when(t.rlike(f"(?i){p}"), F.lit(f"{tag}: {p}")) for p in patterns))
        first = F.when(F.col(tag), which).otherwise(first)
    return out.withColumn("matched_by", first)


def looks_like_prose(token: Column) -> Column:
    """True for a token of several words of which one is prose, or of four words: a title's own part, not a code."""
    words = F.filter(F.split(F.lower(token), r"[\s:]+"), lambda w: w != "")
    words = F.transform(words, lambda w: F.regexp_replace(w, r"^[.,!?]+|[.,!?]+$", ""))
    prose = F.exists(words, lambda w: w.isin(PROSE))
    return ((F.size(words) >= 2) & prose) | (F.size(words) >= 4)


def prefix_token(title: Column | str) -> Column:
    """The code before the first dash, in lower case; null for none, digits only, or prose."""
    token = strip(F.regexp_extract(col(title), PREFIX_TOKEN, 1))
    return F.when((token != "") & ~token.rlike(r"^\d+$") & ~looks_like_prose(token), F.lower(token))


def bracket_token(title: Column | str) -> Column:
    """The text in brackets at the end, in lower case, or null."""
    token = F.lower(strip(F.regexp_extract(col(title), BRACKET_TOKEN, 1)))
    return F.when(token != "", token)


def already_known(title: Column) -> Column:
    """Whether some known pattern catches a title."""
    known = "|".join(f"(?:{p})" for patterns in KNOWN_PATTERNS.values() for p in patterns)
    return title.rlike(f"(?i){known}")
