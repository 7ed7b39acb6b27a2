"""The stemmer against word lists and a character-array version of the algorithm."""

import itertools
import random

import pytest

from lexspark.functions.porter import with_stem

# Steps 2, 3 and 4 as the paper prints them (Program 14(3), 1980), with its two later rules.
STEP_2 = dict(
    rule.split("->")
    for rule in """ational->ate tional->tion enci->ence anci->ance izer->ize bli->ble alli->al entli->ent eli->e ousli->ous
    ization->ize ation->ate ator->ate alism->al iveness->ive fulness->ful ousness->ous aliti->al iviti->ive
    biliti->ble logi->log""".split()
)
STEP_3 = dict(rule.split("->") for rule in "icate->ic ative-> alize->al iciti->ic ical->ic ful-> ness->".split())
STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()

PAIRS = """caresses caress ponies poni ties ti cats cat feed feed agreed agre disabled disabl matting mat
mating mate meeting meet milling mill messing mess meetings meet eating eat going go done done eaten eaten
relational relat conditional condit happy happi sky sky ion ion ies i is is ization izat hopefulness hope
generalization gener adjustment adjust replacement replac probate probat rate rate cease ceas
controll control roll roll say sai yes ye""".split()


def stems(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "term string").repartition(8)
    return {row.term: row.stem for row in with_stem(df).collect()}


def test_pairs(spark):
    pairs = dict(zip(PAIRS[::2], PAIRS[1::2]))
    assert stems(spark, pairs) == pairs


class Letters:
    """A plain reading of the rules, one letter at a time."""

    def __init__(self, word):
        self.w = word

    @staticmethod
    def kinds(w):
        out = []
        for i, c in enumerate(w):
            vowel = c in "aeiou" or (c == "y" and i > 0 and not out[-1])
            out.append(vowel)
        return out

    def measure(self, w):
        kinds = self.kinds(w)
        return sum(a and not b for a, b in zip(kinds, kinds[1:]))

    def vowel(self, w):
        return any(self.kinds(w))

    def double(self, w):
        return len(w) > 1 and w[-1] == w[-2] and not self.kinds(w)[-1]

    def cvc(self, w):
        return len(w) > 2 and self.kinds(w)[-3:] == [False, True, False] and w[-1] not in "wxy"

    def longest(self, w, suffixes):
        found = [s for s in suffixes if w.endswith(s)]
        return max(found, key=len) if found else None

    def stem(self):
        w = self.w
        if len(w) < 3:
            return w
        if w.endswith(("sses", "ies")):
            w = w[:-2]
        elif w.endswith("s") and not w.endswith("ss"):
            w = w[:-1]
        if w.endswith("eed"):
            if self.measure(w[:-3]) > 0:
                w = w[:-1]
        else:
            cut = w[:-2] if w.endswith("ed") else w[:-3] if w.endswith("ing") else None
            if cut is not None and self.vowel(cut):
                w = cut
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif self.double(w):
                    w = w if w[-1] in "lsz" else w[:-1]
                elif self.measure(w) == 1 and self.cvc(w):
                    w += "e"
        if w.endswith("y") and self.vowel(w[:-1]):
            w = w[:-1] + "i"
        for rules in (STEP_2, STEP_3):
            suffix = self.longest(w, rules)
            if suffix and self.measure(w[: -len(suffix)]) > 0:
                w = w[: -len(suffix)] + rules[suffix]
        suffix = self.longest(w, STEP_4)
        if suffix:
            base = w[: -len(suffix)]
            if self.measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t"))):
                w = base
        m = self.measure(w)
        if w.endswith("e") and (m > 1 or (m == 1 and not self.cvc(w[:-1]))):
            w = w[:-1]
        if w.endswith("ll") and m > 1:
            w = w[:-1]
        return w


def test_all_short_words(spark):
    words = ["".join(p) for n in range(1, 7) for p in itertools.product("aeybsl", repeat=n)]
    got = stems(spark, words)
    assert {w: s for w, s in got.items() if s != Letters(w).stem()} == {}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_words_with_suffixes(spark, seed):
    rng = random.Random(seed)
    endings = [*STEP_2, *STEP_3, *STEP_4, *"s es ed ing eed y e ll sses ies 9 ]".split()]
    words = {
        "".join(rng.choices("abcdegilnostuyz3[", k=rng.randint(0, 6))) + "".join(rng.choices(endings, k=rng.randint(1, 3)))
        for _ in range(30000)
    }
    got = stems(spark, words)
    assert {w: s for w, s in got.items() if s != Letters(w).stem()} == {}
