"""Plain versions that results are held against."""

import math
import zlib
from collections import Counter, defaultdict


def fold(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def words(text):
    return (text or "").encode().lower().split()


def katz(docs):
    """[(n_tokens, n_known, train_tokens, base, score)] of (doc_id, text) rows."""
    texts = [(fold(i, 10) != 0, [*words(t), None]) for i, t in docs]
    c = Counter(w for train, ws in texts if train for w in ws)
    pairs = Counter(p for train, ws in texts if train for p in zip(["start", *ws], ws))
    total = sum(c.values())

    def discounts(counts):
        n = [sum(x == r for x in counts.values()) for r in range(1, 7)]
        cut = 6 * n[5] / n[0] if n[0] else 1
        if not all(n) or cut >= 1:
            return [1.0] * 5
        d = [((r + 1) * n[r] / (r * n[r - 1]) - cut) / (1 - cut) for r in range(1, 6)]
        return [x if 0 < x < 1 else 1.0 for x in d]

    d1, d2 = discounts(c), discounts(pairs)
    lost = sum((1 - d1[x - 1]) * x for x in c.values() if x <= 5)
    scale, unseen = (1.0, lost / total) if lost else (total / (total + 1), 1 / (total + 1))

    def p(w):
        return (d1[c[w] - 1] if c[w] <= 5 else 1) * c[w] * scale / total if c[w] else unseen

    after = defaultdict(dict)
    for (v, w), r in pairs.items():
        after[v][w] = (d2[r - 1] if r <= 5 else 1) * r, r
    back, mass = {}, {}
    for v, found in after.items():
        mass[v] = sum(r for _, r in found.values()) + 0.5
        back[v] = (1 - sum(x for x, _ in found.values()) / mass[v]) / max(1 - sum(map(p, found)), unseen)
    for v in list(after)[:20]:
        seen = sum(x for x, _ in after[v].values()) / mass[v]
        assert abs(seen + back[v] * (sum(p(w) for w in c if w not in after[v]) + unseen) - 1) < 1e-9
    out = []
    for _, ws in texts:
        score = 0.0
        for v, w in zip(["start", *ws], ws):
            found = after.get(v)
            q = p(w) if found is None else found[w][0] / mass[v] if w in found else back[v] * p(w)
            score += math.log10(q)
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (len(c) + 1))) for w in ws)
        out.append((len(ws), sum(c[w] > 0 for w in ws), total, base, score))
    return out


def shingles(text):
    ws = words(text)
    return {tuple(ws)} if 0 < len(ws) < 5 else {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}


def near(docs):
    """{index: indices reachable by links of 75 percent} of (doc_id, text) rows."""
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, one in enumerate(sets):
        for j in range(i):
            if one and sets[j] and 100 * len(one & sets[j]) >= 75 * len(one | sets[j]):
                root[find(i)] = find(j)
    return sets, [find(i) for i in range(len(docs))]


def dedup_lines(docs):
    """Texts after later windows of three lines have gone; rows in order of id."""
    seen, out = set(), []
    for _, text in docs:
        if text is None:
            out.append(None)
            continue
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            gone |= {i, i + 1, i + 2} if window in seen else set()
            seen.add(window)
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


# License texts as they are given out, with HOLDER for whoever gives them out.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL HOLDER BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. THIS SOFTWARE IS PROVIDED BY HOLDER "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL HOLDER BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT
NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND HOLDER DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL HOLDER BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
LICENSES = {"mit-text": _MIT, "bsd-text": _BSD, "isc-text": _ISC}
# Words that are not mandatory: the numbers of conditions.
MAY_BE_LEFT_OUT = {k: {i for i, w in enumerate(v.split()) if w in ("1.", "2.")} for k, v in LICENSES.items()}
