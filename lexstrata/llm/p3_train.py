"""Training of the semi-Markov model of problem 3: python -m lexstrata.llm.p3_train JUDGMENTS.parquet > p3_weights.py

The judgments have no labels. A bounded sample of them (SAMPLE rows) is labelled by what is certain:

* names by a role: what stands alone behind a role on a line of its own is a name, and so it is wherever it stands again in
  that judgment. There the model has no role to see, and learns a name by its surroundings;
* names by the model itself: in each round but the first, what the weights of the round before find in the unchanged
  judgments is a name too, since many names never stand behind a role;
* numbers and addresses behind a word that says what they are, or alone in brackets, or of a form that nothing else has,
  and never behind a word that says they are something else.

The few surnames of a sample say nothing about others. So half of the judgments are read with other names in place of
theirs: a common surname with given names of any characters, at the same places, behind roles within sentences, and before
words that ordinary text doesn't have. What ordinary text has is counted in the judgments without their names.

The weights maximize the conditional likelihood of the labelled segmentations, less a quadratic penalty, by Adagrad.
"""

from __future__ import annotations

import base64
import math
import random
import re
import sys
from bisect import bisect_right
from collections import Counter, defaultdict

import numpy as np

from .p3_personal import ROLES

SAMPLE, EPOCHS, ROUNDS, RATE, PENALTY, SEED = 1_200, 6, 3, 0.25, 1e-5, 7
LEAST_CHARS, LEAST_PAIRS = 0.01, 0.0025
_LINE = re.compile(rf"(?m)^[ 　]*(?:{'|'.join('[ 　]*'.join(r) for r in ROLES)})(?:[：:][ 　]*|[ 　]+)([^\s○〇：，。]+(?:[ -][A-ZÀ-Þ][a-zà-öø-ÿ]+)?)[ 　]*\r?$")
_NAME = re.compile(r"[一-鿿]{2,4}|[一-鿿]{2,5}[·‧・•][一-鿿]{2,5}|[A-ZÀ-Þ][a-zà-öø-ÿ]+[ -]?[A-ZÀ-Þ][a-zà-öø-ÿ]+")
_NO_NAME = re.compile("住|詳卷|同上|公司|商行|法院|[原被]告|[人官]$")
# Characters that are usual in given names.
GIVEN = "明華美文志豪淑芬怡君俊傑雅婷家宏建國玉珍秀英惠雯佳慧宗翰承恩品妤宇軒子涵冠廷詩涵信義榮春小大德仁忠孝安平"


def names_of(text: str) -> set[str]:
    return {n for n in _LINE.findall(text) if _NAME.fullmatch(n) and not _NO_NAME.search(n)}


def mask(text: str, names: set[str]) -> str:
    text = re.sub("[一-鿿][○〇ＯＸ*＊]+", "\n", text)
    return re.sub("|".join(sorted(map(re.escape, names), key=len, reverse=True)), "\n", text) if names else text


def ordinary(texts: list[str], names: list[set[str]], strict: int = 1):
    """The ideographs and pairs that a share of the texts has outside their names."""
    from . import p3_personal as p3

    chars, pairs = Counter(), Counter()
    for text, some in zip(texts, names):
        text = mask(text, some)
        chars.update(set(re.findall("[一-鿿]", text)))
        pairs.update({text[m.start() : m.start() + 2] for m in re.finditer("[一-鿿](?=[一-鿿])", text)})
    known = np.zeros(0xA000 - 0x4E00, bool)
    known[[ord(c) - 0x4E00 for c, n in chars.items() if n >= strict * LEAST_CHARS * len(texts)]] = True
    some = [p for p, n in pairs.items() if n >= LEAST_PAIRS * len(texts)]
    bits = np.zeros(1 << p3.PAIR_BITS, bool)
    bits[p3.pair_slots(np.array([ord(p[0]) for p in some]), np.array([ord(p[1]) for p in some]))] = True
    return p3.Ordinary(known, bits)


def new_name(rng: random.Random, old: str, common: list[str], compound: list[str]) -> str:
    """A name in place of old, of the same kind."""
    any_ = lambda: chr(rng.randrange(0x4E00, 0x9FA5)) if rng.random() < 0.3 else rng.choice(GIVEN)
    if re.search("[·‧・•]", old):
        return re.sub("[一-鿿]", lambda m: any_(), old)
    if not "一" <= old[0] <= "鿿":
        return re.sub("[a-zà-öø-ÿ]{2,}", lambda m: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 6))), old)
    surname = rng.choice(compound) if rng.random() < 0.05 else old[0] if rng.random() < 0.15 else rng.choice(common)
    return surname + "".join(any_() for _ in range(2 if rng.random() < 0.85 else 1))


def varied(rng: random.Random, text: str, old_names: set[str]) -> tuple[str, set[str]]:
    """text with other names, some of them behind roles within sentences, some before strange words; and its names."""
    from . import p3_personal as p3

    common, compound = sorted(p3.COMMON), sorted(p3.COMPOUND)
    names = set()
    for old in sorted(old_names, key=len, reverse=True):
        new = new_name(rng, old, common, compound)
        names.add(new)
        text = text.replace(old, new)
    usual = re.findall("[一-鿿]", text) or ["的"]
    # A word that ordinary text doesn't have, of strange or of usual characters.
    sign = lambda x: chr(rng.randrange(0x4E00, 0x9FA5)) if x < 0.25 else rng.choice(common) if x < 0.4 else rng.choice(usual)
    word = lambda: "".join(sign(rng.random()) for _ in range(rng.randint(2, 5)))
    latin = lambda: rng.choice("ABCDEFGHJKLMNPRSTW") + "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7)))
    clauses = re.split("(?<=[，。；])", text)
    for i, clause in enumerate(clauses):
        m = re.match("(?:原告|被告|證人|聲請人|告訴人)(?=[一-鿿])", clause)
        if m and rng.random() < 0.4:
            name = new_name(rng, "某", common, compound)
            names.add(name)
            before = m[0] if rng.random() < 0.4 else rng.choice(["", "", "", "", "當日", "由", "與", "向", word()])
            clauses[i] = before + name + rng.choice(["", "律師", "先生", "之", "於", *(word() for _ in range(6))]) + clause[m.end() :]
        elif rng.random() < 0.02:
            # Strange words within a clause are no names.
            at = len(clause) // 2
            clauses[i] = clause[:at] + word() + clause[at:]
    if rng.random() < 0.5:
        name = f"{latin()} {latin()}"
        names.add(name)
        clauses.append(f"\n{rng.choice(['Mr ', 'Mrs ', 'Ms ', 'Dr ', ''])}{name} lives at {rng.randint(1, 99)} {latin()} {rng.choice(['St', 'Rd', 'Ave', 'Blvd'])}. The {latin()} {rng.choice(['City', 'Dist'])} archive has it.\n")
    return "".join(clauses), names


def labels(text: str, names: set[str], some) -> set[tuple[int, int, str]]:
    """The certain segments of text."""
    gold = set()
    for c in some:
        span, f = text[c.start : c.end], set(c.features)
        key = (c.start, c.end, c.type)
        if c.type == "name" and span in names and "name:company" not in f:
            gold.add(key)
        elif c.type == "email" and not f & {"email:later", "email:shorter"}:
            gold.add(key)
        elif c.type == "phone" and not f & {"phone:not", "phone:cut_left", "phone:cut_right", "phone:unclosed"}:
            first = next((x[12:] for x in f if x.startswith("phone:first=")), "")
            if f & {"phone:size=8", "phone:size=9", "phone:size=foreign"} and (f & {"phone:country"} or first.startswith("zero")) and f & {"phone:cue", "phone:parted", "phone:country", "phone:first=zero:9"}:
                gold.add(key)
        elif c.type == "id_number" and not f & {"id:not", "id:cut"} and f & {"id:cue", "id:one:second=usual"}:
            gold.add(key)
        elif c.type == "address" and not f & {"address:lot", "address:more", "address:city=3"}:
            gold.add(key)
    # Of segments that overlap the longest is right.
    out: set[tuple[int, int, str]] = set()
    for key in sorted(gold, key=lambda x: (x[0] - x[1], x)):
        if all(key[1] <= a or b <= key[0] for a, b, _ in out):
            out.add(key)
    return out


def likelihood(spans: list[tuple[int, int]], scores: list[float], touch: float) -> tuple[float, list[float], float]:
    """The logarithm of the sum over all segmentations, the probability of each segment, and the expected number of touching
    pairs: forward and backward sums over the ends. spans: sorted by end."""
    n = len(spans)
    ends = sorted({b for _, b in spans} | {a for a, _ in spans} | {0})
    at = {e: k for k, e in enumerate(ends)}
    into, outof = [[] for _ in ends], [[] for _ in ends]
    for i, (a, b) in enumerate(spans):
        into[at[b]].append(i)
        outof[at[a]].append(i)

    def add(x: float, y: float) -> float:
        if x < y:
            x, y = y, x
        return x if y == -math.inf else x + math.log1p(math.exp(y - x))

    # Paths up to an end: those whose last segment ends there, and the others. All in logarithms.
    free, closed, begin = [0.0] * len(ends), [-math.inf] * len(ends), [0.0] * n
    total = 0.0
    for k in range(len(ends)):
        free[k] = total
        for i in into[k]:
            closed[k] = add(closed[k], begin[i] + scores[i])
        total = add(free[k], closed[k])
        for i in outof[k]:
            begin[i] = add(free[k], closed[k] + touch)
    z = total
    # The same from behind: after[k] of what follows an end, where no segment ended there or one did.
    after_free, after_closed = [0.0] * (len(ends) + 1), [0.0] * (len(ends) + 1)
    prob, pairs = [0.0] * n, 0.0
    rest = 0.0
    for k in range(len(ends) - 1, -1, -1):
        starts = -math.inf
        for i in outof[k]:
            starts = add(starts, scores[i] + after_closed[at[spans[i][1]]])
        after_free[k] = add(rest, starts)
        after_closed[k] = add(rest, starts + touch)
        if starts > -math.inf and closed[k] > -math.inf:
            pairs += math.exp(min(0.0, closed[k] + touch + starts - z))
        # Before this place nothing is open: a path comes here with no segment ended, or with one of those that end here.
        rest = after_free[k]
    for i, (_, b) in enumerate(spans):
        prob[i] = math.exp(min(0.0, begin[i] + scores[i] + after_closed[at[b]] - z))
    return z, prob, pairs


def train(data: list[tuple[list, set]]) -> dict[str, float]:
    from . import p3_personal as p3

    weights: dict[str, float] = defaultdict(float)
    squares: dict[str, float] = defaultdict(lambda: 1e-3)
    rng = random.Random(SEED)
    for epoch in range(EPOCHS):
        rng.shuffle(data)
        loss = 0.0
        for some, gold in data:
            scores = [p3.score(c, weights) for c in some]
            z, prob, pairs = likelihood([(c.start, c.end) for c in some], scores, weights["touch"])
            grad: dict[str, float] = defaultdict(float)
            for c, p, s in zip(some, prob, scores):
                y = (c.start, c.end, c.type) in gold
                loss -= s * y
                if abs(y - p) > 1e-6:
                    for f in c.features:
                        grad[f] += y - p
            stops = {b for _, b, _ in gold}
            touching = sum(a in stops for a, _, _ in gold)
            grad["touch"] += touching - pairs
            loss += z - touching * weights["touch"]
            for f, g in grad.items():
                g -= PENALTY * weights[f]
                squares[f] += g * g
                weights[f] += RATE * g / math.sqrt(squares[f])
        print(f"epoch {epoch}: {loss / len(data):.4f}", file=sys.stderr)
    return {f: round(w, 3) for f, w in sorted(weights.items())}


def main(path: str) -> None:
    import pyarrow.dataset as ds

    from . import p3_personal as p3

    rows = ds.dataset(path).head(SAMPLE, columns=["jfull"]).column("jfull").to_pylist()
    texts = [t for t in rows if t]
    names = [names_of(t) for t in texts]
    weights: dict[str, float] = {}
    for r in range(ROUNDS):
        # Before the first round many names aren't known yet, and their characters stand in ordinary text.
        usual = ordinary(texts, names, 1 if weights else 4)
        if weights:
            for text, some in zip(texts, names):
                some |= {text[c.start : c.end] for c in p3.decode(p3.candidates(text, weights, usual), weights) if c.type == "name"}
            usual = ordinary(texts, names)
        rng = random.Random(SEED)
        data = []
        for k, (text, some) in enumerate(zip(texts, names)):
            for text, some in ((text, some), varied(rng, text, some)):
                # Retrieval chunks have no white space.
                if k % 2:
                    text, some = re.sub("[ 　\t]", "", text), {re.sub("[ 　]", "", x) for x in some}
                found = sorted(p3.candidates(text, None, usual), key=lambda c: (c.end, c.start))
                data.append((found, labels(text, some, found)))
        weights = train(data)
    text = lambda bits: base64.b64encode(np.packbits(bits, bitorder="little")).decode()
    print('"""Trained by p3_train; not written by hand."""\n')
    print("# Bits, in base 64: ideographs from U+4E00 on, and hashed pairs of ideographs, of ordinary text.")
    print(f'KNOWN_CHARS = "{text(usual.chars[0x4E00:0xA000])}"\nKNOWN_PAIRS = "{text(usual.pairs)}"\nWEIGHTS = {{')
    print("".join(f'    "{f}": {w},\n' for f, w in weights.items() if w) + "}")


if __name__ == "__main__":
    main(sys.argv[1])
