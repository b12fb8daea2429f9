"""The stemmer: pairs of the published sample vocabulary, and a plain reading of the rules over many made-up words."""

import random
import re

from quillon.functions import porter

# Words and stems of the published sample.
SAMPLE = """consign consign consigned consign consigning consign consignment consign consist consist consisted consist consistency consist consistent consist consistently consist consisting consist
consists consist consolation consol consolations consol consolatory consolatori console consol consoled consol consoles consol consolidate consolid consolidated consolid consolidating consolid
consoling consol consolingly consol consols consol consonant conson consort consort consorted consort consorting consort conspicuous conspicu conspicuously conspicu conspiracy conspiraci
conspirator conspir conspirators conspir conspire conspir conspired conspir conspiring conspir constable constabl constables constabl constance constanc constancy constanc constant constant
knack knack knackeries knackeri knacks knack knag knag knave knave knaves knave knavish knavish kneaded knead kneading knead knee knee kneel kneel kneeled kneel kneeling kneel kneels kneel
knees knee knell knell knelt knelt knew knew knick knick knif knif knife knife knight knight knightly knight knights knight knit knit knits knit knitted knit knitting knit knives knive
knob knob knobs knob knock knock knocked knock knocker knocker knockers knocker knocking knock knocks knock knopp knopp knot knot knots knot
skies sky dying die news news generate generat generic generic communism communism succeeding succeed proceed proceed hopping hop hoping hope falling fall happy happi say say by by cries cri
ties tie gas gas this this kiwis kiwi feed feed agreed agre luxuriated luxuri relational relat rational ration decisiveness decis hopefulness hope analogously analog yes yes youth youth boy boy
formality formal adoption adopt controlled control bed bed shed shed""".split()


def plain(word):
    """The rules, read once more with slices of strings."""
    if len(word) <= 2 or word in porter.IRREGULAR:
        return porter.IRREGULAR.get(word, word)
    w = ""
    for i, c in enumerate(word):
        w += "Y" if c == "y" and (i == 0 or w[-1] in "aeiouy") else c
    def after(text, at):
        while at < len(text) and text[at] not in "aeiouy":
            at += 1
        while at < len(text) and text[at] in "aeiouy":
            at += 1
        return min(at + 1, len(text))
    r1 = next((len(p) for p in porter.PREFIXES if w.startswith(p)), after(w, 0))
    r2 = after(w, r1)
    vowels = lambda t: any(c in "aeiouy" for c in t)
    def short(t):
        if len(t) == 2:
            return t[0] in "aeiouy" and t[1] not in "aeiouy"
        return len(t) > 2 and t[-3] not in "aeiouy" and t[-2] in "aeiouy" and t[-1] not in "aeiouywxY"
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and vowels(w[:-2]):
        w = w[:-1]
    if w in porter.DONE_AFTER_PLURAL:
        return w
    s = next((s for s in ("eedly", "ingly", "edly", "eed", "ing", "ed") if w.endswith(s)), "")
    if s.startswith("eed"):
        w = w[: -len(s)] + "ee" if len(w) - len(s) >= r1 else w
    elif s and vowels(w[: -len(s)]):
        w = w[: -len(s)]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif w[-2:] in ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"):
            w = w[:-1]
        elif short(w) and len(w) <= r1:
            w += "e"
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in "aeiouy":
        w = w[:-1] + "i"
    def swap(w, table, fits):
        s = max((s for s in table if w.endswith(s)), key=len, default=None)
        return w[: -len(s)] + table[s] if s is not None and fits(s, w[: -len(s)]) else w
    w = swap(w, porter.STEP2, lambda s, rest: len(rest) >= r1 and (s != "ogi" or rest.endswith("l")) and (s != "li" or rest[-1:] in tuple("cdeghkmnrt")))
    w = swap(w, porter.STEP3, lambda s, rest: len(rest) >= (r2 if s == "ative" else r1))
    w = swap(w, dict.fromkeys(porter.STEP4, ""), lambda s, rest: len(rest) >= r2 and (s != "ion" or rest[-1:] in ("s", "t")))
    if w.endswith("e") and (len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not short(w[:-1]))) or (w.endswith("ll") and len(w) - 1 >= r2):
        w = w[:-1]
    return w.lower()


def test_sample_and_plain_rules(spark):
    g = random.Random(3)
    ends = [*porter.STEP2, *porter.STEP3, *porter.STEP4, "s", "es", "ies", "ied", "ed", "edly", "ing", "ingly", "eed", "eedly", "e", "ll", "y", "sses", "us", ""]
    begin = ["", "y", "gener", "commun", "arsen", "str", "hop", "ay", "eye"]
    words = {g.choice(begin) + "".join(g.choice("aeiouybdlmnprstwx") for _ in range(g.randint(0, 6))) + g.choice(ends) + g.choice(["", "", "ly", "s", "ing"]) for _ in range(6000)}
    sample = dict(zip(SAMPLE[::2], SAMPLE[1::2]))
    assert all(re.fullmatch("[a-z]+", w) for w in sample)
    got = {r.word: r.stem for r in porter.stems(spark.createDataFrame([(w,) for w in words | set(sample)] + [(None,)], "word string")).collect()}
    assert got.pop(None) is None
    assert {w: got[w] for w in sample} == sample
    assert {w: got[w] for w in words} == {w: plain(w) for w in words}
