"""The backoff model by plain dictionaries."""

import math
import re
import zlib
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
START, END = ("start",), ("end",)


def held_out(doc_id):
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def discounts(sizes):
    out = {}
    cut = 6 * sizes[6] / sizes[1] if sizes[1] else 1.0
    for r in range(1, 6):
        d = -1.0
        if sizes[r] and cut < 1:
            d = ((r + 1) * sizes[r + 1] / sizes[r] / r - cut) / (1 - cut)
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class Model:
    def __init__(self, docs):
        lines = [self.tokens(text) for doc_id, text in docs if not held_out(doc_id)]
        self.count = Counter(w for line in lines for w in line)
        self.pairs = defaultdict(Counter)
        for line in lines:
            for h, w in zip([START, *line], line):
                self.pairs[h][w] += 1
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.d = discounts(Counter(r for c in self.pairs.values() for r in c.values()))

    @staticmethod
    def tokens(text):
        return [*WORDS.findall((text or "").translate(LOWER)), END]

    def base(self, w):
        return (self.count[w] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def probability(self, h, w):
        seen = self.pairs.get(h)
        if not seen:
            return self.base(w)
        total = sum(seen.values())
        left = sum(r * (1 - self.d.get(r, 1.0)) for r in seen.values())
        if left <= 0:
            total, left = total + 1, 1.0
        if w in seen:
            return self.d.get(seen[w], 1.0) * seen[w] / total
        alpha = left / total / (1 - sum(self.base(x) for x in seen))
        return alpha * self.base(w)

    def row(self, doc_id, text):
        line = self.tokens(text)
        return {
            "doc_id": doc_id,
            "held_out": held_out(doc_id),
            "n_tokens": len(line),
            "n_known": sum(self.count[w] > 0 for w in line),
            "train_tokens": self.n,
            "base_score": sum(math.log10(self.base(w)) for w in line),
            "score": sum(math.log10(self.probability(h, w)) for h, w in zip([START, *line], line)),
        }
