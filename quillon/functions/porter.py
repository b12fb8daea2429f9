"""The Porter2 stemmer of English as columns, over a table of distinct words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.plan import once

# The published rules. A suffix gives way to another text; the longest that fits decides, in its region.
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
DONE_AFTER_PLURAL = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
PREFIXES = ["gener", "commun", "arsen"]
STEP2 = {
    "ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive", "tional": "tion", "biliti": "ble", "lessli": "less", "entli": "ent", "ation": "ate",
    "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive", "fulli": "ful", "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate", "alli": "al", "bli": "ble",
    "ogi": "og", "li": "",
}
STEP3 = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ative": "", "ical": "ic", "ness": "", "ful": ""}
STEP4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic"]
VOWEL, OTHER, DOUBLE, LI_ENDING = "[aeiouy]", "[^aeiouy]", "(bb|dd|ff|gg|mm|nn|pp|rr|tt)$", "[cdeghkmnrt]li$"
SHORT = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"
REGION = f"^.*?{VOWEL}{OTHER}"


def _less(n: int, word: Column | None = None) -> Column:
    """The word without its last n letters."""
    word = F.col("#w") if word is None else word
    return F.left(word, F.length(word) - n)


def _by_suffix(rules: dict[str, Column]) -> Column:
    """The value of the longest suffix that the word ends with; the word itself if none does."""
    out = F
    for suffix in sorted(rules, key=lambda s: -len(s)):
        out = out.when(F.col("#w").endswith(suffix), rules[suffix])
    return out.otherwise(F.col("#w"))


def _in(region: Column, suffix: str, then: Column, also: Column | None = None) -> Column:
    """`then` if the suffix lies in the region (and something else holds), otherwise the word."""
    fits = F.length("#w") - len(suffix) >= region
    return F.when(fits if also is None else fits & also, then).otherwise(F.col("#w"))


def stems(words: DataFrame, word: str = "word") -> DataFrame:
    """words with the column `stem`. Words are lower-case; those of one or two letters stay, and null stays null.

    Regions R1 and R2 begin where the published rules put them and are kept as positions. Every step is computed once a
    row, as the next one reads it several times.
    """
    _w, _r1, _r2 = F.col("#w"), F.col("#r1"), F.col("#r2")
    df = once(words, {"#w": F.regexp_replace(word, f"(^|{VOWEL})y", "$1Y")})
    start = F.regexp_extract("#w", f"^({'|'.join(PREFIXES)})", 0)
    region = lambda text: F.length(F.regexp_extract(text, REGION, 0))
    df = once(df, {"#r1": F.when(start != "", F.length(start)).otherwise(region(_w))})
    df = once(df, {"#r1": F.when(_r1 == 0, F.length(_w)).otherwise(_r1)})
    df = once(df, {"#r2": region(F.substr(_w, _r1 + 1))})
    df = once(df, {"#r2": F.when(_r2 == 0, F.length(_w)).otherwise(_r1 + _r2)})
    # Plurals.
    ie = F.when(F.length(_w) > 4, _less(2)).otherwise(_less(1))
    df = once(df, {"#w": _by_suffix({"sses": _less(2), "ied": ie, "ies": ie, "us": _w, "ss": _w, "s": F.when(_less(2).rlike(VOWEL), _less(1)).otherwise(_w)})})
    df = once(df, {"#done": F.when(_w.isin(DONE_AFTER_PLURAL), _w)})
    # Past tenses and -ing: what is cut may need a letter more or less.
    ee = {s: _in(_r1, s, F.concat(_less(len(s)), F.lit("ee"))) for s in ("eed", "eedly")}
    before = F
    for suffix in ("ingly", "edly", "ing", "ed"):
        before = before.when(_w.endswith(suffix) & ~_w.rlike("eed(ly)?$"), _less(len(suffix)))
    df = once(df, {"#cut": before})
    df = once(df, {"#cut": F.when(F.col("#cut").rlike(VOWEL), F.col("#cut"))})
    cut = F.col("#cut")
    mended = F.when(cut.rlike("(at|bl|iz)$"), F.concat(cut, F.lit("e"))).when(cut.rlike(DOUBLE), _less(1, cut)).when(cut.rlike(SHORT) & (F.length(cut) <= _r1), F.concat(cut, F.lit("e"))).otherwise(cut)
    df = once(df, {"#w": F.when(cut.isNotNull(), mended).otherwise(_by_suffix(ee))})
    df = once(df, {"#w": F.when(_w.rlike(f".{OTHER}[yY]$"), F.concat(_less(1), F.lit("i"))).otherwise(_w)})
    also = {"ogi": _w.endswith("logi"), "li": _w.rlike(LI_ENDING)}
    df = once(df, {"#w": _by_suffix({s: _in(_r1, s, F.concat(_less(len(s)), F.lit(to)), also.get(s)) for s, to in STEP2.items()})})
    df = once(df, {"#w": _by_suffix({s: _in(_r2 if s == "ative" else _r1, s, F.concat(_less(len(s)), F.lit(to))) for s, to in STEP3.items()})})
    df = once(df, {"#w": _by_suffix({s: _in(_r2, s, _less(len(s)), _w.rlike("[st]ion$") if s == "ion" else None) for s in STEP4})})
    last = F.length(_w) - 1
    e = _w.endswith("e") & ((last >= _r2) | ((last >= _r1) & ~_less(1).rlike(SHORT)))
    df = once(df, {"#w": F.when(e | (_w.endswith("ll") & (last >= _r2)), _less(1)).otherwise(_w)})
    irregular = F.create_map(*(F.lit(x) for pair in IRREGULAR.items() for x in pair))
    stem = F.when(F.length(word) <= 2, F.col(word)).otherwise(F.coalesce(F.element_at(irregular, F.col(word)), F.lower(F.coalesce("#done", "#w"))))
    return once(df, {"stem": stem}).drop("#w", "#r1", "#r2", "#done", "#cut")
