"""English stemming after Porter's second algorithm (pure Python, from its published description)."""

from __future__ import annotations

from functools import lru_cache

_VOWELS = "aeiouy"
_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_WHOLE = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl"}
_SAME = frozenset("sky news howe atlas cosmos bias andes".split())
_AFTER_1A = frozenset("inning outing canning herring earring proceed exceed succeed".split())
_STEP2 = sorted(
    {
        "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al",
        "alli": "al", "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
    }.items(),
    key=lambda x: -len(x[0]),
)
_STEP3 = sorted({"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "", "ative": ""}.items(), key=lambda x: -len(x[0]))
_STEP4 = sorted("al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split(), key=lambda x: -len(x))

STOP = frozenset(
    """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them their theirs
    themselves what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if or
    because as until while of at by for with about against between into through during before after above below to from up down in out on off over under
    again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t
    can will just don should now""".split()
)


def _regions(w: str) -> tuple[int, int]:
    def after(start: int) -> int:
        for i in range(start + 1, len(w)):
            if w[i] not in _VOWELS and w[i - 1] in _VOWELS:
                return i + 1
        return len(w)

    r1 = next((len(p) for p in ("gener", "commun", "arsen") if w.startswith(p)), None)
    r1 = after(0) if r1 is None else r1
    return r1, after(r1)


def _short_syllable(w: str) -> bool:
    """Whether w ends in a short syllable."""
    if len(w) == 2:
        return w[0] in _VOWELS and w[1] not in _VOWELS
    return len(w) > 2 and w[-1] not in _VOWELS + "wxY" and w[-2] in _VOWELS and w[-3] not in _VOWELS


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    w = word.lower()
    if len(w) <= 2:
        return w
    if w in _WHOLE:
        return _WHOLE[w]
    if w in _SAME:
        return w
    w = w.lstrip("'")
    if w.startswith("y"):
        w = "Y" + w[1:]
    w = "".join("Y" if c == "y" and i and w[i - 1] in _VOWELS else c for i, c in enumerate(w))
    r1, r2 = _regions(w)
    w = next((w[: -len(s)] for s in ("'s'", "'s", "'") if w.endswith(s)), w)
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and any(c in _VOWELS for c in w[:-2]):
        w = w[:-1]
    if w in _AFTER_1A:
        return w.lower()
    if w.endswith(("eed", "eedly")):
        cut = 5 if w.endswith("eedly") else 3
        if len(w) - cut >= r1:
            w = w[:-cut] + "ee"
    else:
        for s in ("ingly", "edly", "ing", "ed"):
            if w.endswith(s):
                base = w[: -len(s)]
                if any(c in _VOWELS for c in base):
                    w = base
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(_DOUBLES):
                        w = w[:-1]
                    elif _short_syllable(w) and r1 >= len(w):
                        w += "e"
                break
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _VOWELS:
        w = w[:-1] + "i"
    for s, to in _STEP2:
        if w.endswith(s):
            ok = len(w) - len(s) >= r1
            if s == "ogi":
                ok = ok and w.endswith("logi")
            if s == "li":
                ok = ok and len(w) > 2 and w[-3] in "cdeghkmnrt"
            if ok:
                w = w[: -len(s)] + to
            break
    for s, to in _STEP3:
        if w.endswith(s):
            if len(w) - len(s) >= (r2 if s == "ative" else r1):
                w = w[: -len(s)] + to
            break
    for s in _STEP4:
        if w.endswith(s):
            if len(w) - len(s) >= r2 and (s != "ion" or (len(w) > 3 and w[-4] in "st")):
                w = w[: -len(s)]
            break
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_syllable(w[:-1])):
            w = w[:-1]
    elif w.endswith("l") and len(w) - 1 >= r2 and w[-2:-1] == "l":
        w = w[:-1]
    return w.lower()
