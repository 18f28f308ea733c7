"""License scans: phrases, and templates with markup compiled into token automata.

Texts are read as words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`, A-Z as a-z. The base counts the places where a
phrase's words stand one after the other. The method finds templates: `<<beginOptional>> ...
<<endOptional>>` may be missing, `<<var;words=n>>` is replaced by up to n words, of `<<oneOf>> ... <<or>> ...
<<endOneOf>>` one wording stands, and all other words are mandatory and must stand exactly as written. A
template becomes an automaton over words, run from every place where its first mandatory word stands. Of the
matches that start at one place the longest gives its label, so that `CC BY` is not found in `CC BY-NC`.
License texts are templates as a whole; one that begins alike and then differs has the label of the opening.

A text goes through the automata only if it has a word that one of them starts with; everything else is one
pass over its bytes. Nothing is shuffled.

`score` is 1 with a template's label, else 0.6 with base labels, else 0; openings do not count. Nulls: a null
text is empty; it has no words and no labels. Null ids are carried; repeated rows are separate. Long texts are
scanned whole. Other columns are not read and cannot clash. An empty table gives an empty result.
"""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import documents

# The base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_AS_IS = "<<oneOf>>AS IS<<or>>“AS IS”<<endOneOf>>"
_GPL = """under <<beginOptional>>the terms of<<endOptional>> the GNU {} General Public License <<beginOptional>>as published by
    the Free Software Foundation<<endOptional>> <<beginOptional>>version <<oneOf>>1<<or>>2<<or>>3<<endOneOf>>
    <<beginOptional>>0<<endOptional>> <<beginOptional>>or <<beginOptional>>any<<endOptional>> later
    <<beginOptional>>version<<endOptional>><<endOptional>><<endOptional>>"""
_APACHE = """Licensed under the Apache License <<beginOptional>><<oneOf>>Version 2<<or>>v2<<endOneOf>>
    <<beginOptional>>0<<endOptional>><<endOptional>>"""
_MIT = "released under the MIT License"
_NC = "<<oneOf>>NC<<or>>NonCommercial<<or>>Non Commercial<<endOneOf>>"
_ND = "<<oneOf>>ND<<or>>NoDerivatives<<or>>NoDerivs<<or>>No Derivatives<<or>>No Derivs<<endOneOf>>"
_SA = "<<oneOf>>SA<<or>>ShareAlike<<or>>Share Alike<<endOneOf>>"


def _cc(more: str = "") -> str:
    long = "".join(f"<<beginOptional>>{x}<<endOptional>> " for x in (_NC, _ND, _NC, _SA)) if more else ""
    return f"""licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>>
        <<beginOptional>>Creative Commons<<endOptional>> <<beginOptional>>Attribution {long}<<endOptional>> CC BY {more}
        <<beginOptional>>4.0<<endOptional>>"""


# Wording of common license texts and notices, with optional and replaceable regions. A short
# notice has further ones beside it that begin alike and name another license.
TEMPLATES = {
    "mit-text": f"""Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files <<oneOf>>(the "Software")<<or>>(the “Software”)<<endOneOf>>, to deal in the
        Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, <<oneOf>>sublicense<<or>>sub-license<<endOneOf>>, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright
        notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be
        included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED {_AS_IS}, WITHOUT
        WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND <<oneOf>>NONINFRINGEMENT<<or>>NON-INFRINGEMENT<<endOneOf>>. IN NO EVENT
        SHALL <<var;words=20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
        TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
        SOFTWARE""",
    "apache-notice": _APACHE,
    "apache-1-notice": """Licensed under the Apache License <<oneOf>>Version 1<<or>>v1<<endOneOf>>
        <<beginOptional>><<oneOf>>0<<or>>1<<endOneOf>><<endOptional>>""",
    "apache-exception-notice": f"{_APACHE} with <<var;words=4>> <<oneOf>>Exception<<or>>Exceptions<<endOneOf>>",
    "gpl-notice": _GPL.format(""),
    "gpl-exception-notice": f"""{_GPL.format("")} with <<var;words=4>>
        <<oneOf>>Exception<<or>>Exceptions<<endOneOf>>""",
    "lgpl-notice": _GPL.format("<<oneOf>>Lesser<<or>>Library<<endOneOf>>"),
    "agpl-notice": _GPL.format("Affero"),
    "bsd-text": f"""Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: <<beginOptional>><<oneOf>>1<<or>>a<<or>>i<<endOneOf>><<endOptional>>
        Redistributions of source code must retain the above copyright notice, this list of conditions and the following
        disclaimer. <<beginOptional>><<oneOf>>2<<or>>b<<or>>ii<<endOneOf>><<endOptional>> Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution. <<beginOptional>>
        <<beginOptional>><<oneOf>>3<<or>>c<<or>>iii<<endOneOf>><<endOptional>> Neither the name of <<var;words=20>> nor
        the names of <<oneOf>>its<<or>>the<<or>>their<<or>>other<<endOneOf>> contributors may be used to endorse or
        promote products derived from this software without specific prior written permission.<<endOptional>> THIS
        SOFTWARE IS PROVIDED BY <<var;words=20>> {_AS_IS} AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
        LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
        EVENT SHALL <<var;words=20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
        DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
        PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
        LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF
        ADVISED OF THE POSSIBILITY OF SUCH DAMAGE""",
    "isc-text": f"""Permission to use, copy, modify, and <<beginOptional>>or<<endOptional>> distribute this software for
        any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies. THE SOFTWARE IS PROVIDED {_AS_IS} AND <<var;words=20>> DISCLAIMS ALL WARRANTIES WITH
        REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
        <<var;words=20>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER
        RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
        ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE""",
    "cc-by-notice": _cc(),
    "cc-by-nc-notice": _cc(_NC),
    "cc-by-nd-notice": _cc(_ND),
    "cc-by-sa-notice": _cc(_SA),
    "cc-by-nc-nd-notice": _cc(f"<<oneOf>>{_NC} {_ND}<<or>>{_ND} {_NC}<<endOneOf>>"),
    "cc-by-nc-sa-notice": _cc(f"<<oneOf>>{_NC} {_SA}<<or>>{_SA} {_NC}<<endOneOf>>"),
    "mit-notice": _MIT,
    "commons-clause-notice": f"""<<oneOf>>{_APACHE}<<or>>{_MIT}<<or>>{_GPL.format("")}<<endOneOf>> with
        <<beginOptional>>the<<endOptional>> Commons Clause""",
    "copyright-notice": """Copyright <<beginOptional>>c<<endOptional>> <<var;words=6>> All rights reserved""",
}

# How the license texts begin. Where one goes on in another way, no license is found.
OPENINGS = {
    "mit-text-opening": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files <<beginOptional>><<oneOf>>the "Software"<<or>>(the “Software”)<<endOneOf>>
        <<endOptional>>, to deal in the Software without restriction""",
    "bsd-text-opening": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met""",
    "isc-text-opening": """Permission to use, copy, modify, and <<beginOptional>>or<<endOptional>> distribute this
        software for any purpose with or without fee is hereby granted""",
}

_KEEP = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_MARKUP = re.compile(r"<<(beginOptional|endOptional|oneOf|or|endOneOf|var;words=(\d+))>>")


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_KEEP).split()


def compile_template(template: str) -> list[tuple[bytes | None, set[int]]]:
    """States (the word that leads on, or None for any; where else one may go for nothing).

    State i is left by its word to i + 1; a region that may be missing adds a way past it, and a
    replaceable one of n words is n states that any word leaves, each with a way to its end. Of several
    wordings, the first state has a way to each, and each ends in a state that no word leaves, with a way
    past the others.
    """
    words: list[bytes | None] = []
    skips: dict[int, set[int]] = {}
    opened: list[int] = []
    choices: list[tuple[int, list[int]]] = []
    at = 0
    for mark in [*_MARKUP.finditer(template), None]:
        stop = mark.start() if mark else len(template)
        words += words_of(template[at:stop])
        if mark is None:
            break
        at = mark.end()
        if mark[1] == "beginOptional":
            opened.append(len(words))
        elif mark[1] == "endOptional":
            skips.setdefault(opened.pop(), set()).add(len(words))
        elif mark[1] == "oneOf":
            choices.append((len(words), []))
        elif mark[1] == "or":
            first, ends = choices[-1]
            ends.append(len(words))
            words.append(b"")
            skips.setdefault(first, set()).add(len(words))
        elif mark[1] == "endOneOf":
            for i in choices.pop()[1]:
                skips.setdefault(i, set()).add(len(words))
        else:
            end = len(words) + int(mark[2])
            for i in range(len(words), end):
                skips.setdefault(i, set()).add(end)
            words += [None] * int(mark[2])
    return [(w, skips.get(i, set())) for i, w in enumerate(words)]


class Automaton:
    """A compiled template: `first` words that can begin a match, and steps over sets of states."""

    def __init__(self, template: str):
        self.states = compile_template(template)
        self.end = len(self.states)
        self.start = self._closed({0})
        self.first = {self.states[i][0] for i in self.start if i < self.end}

    def _closed(self, states: set[int]) -> frozenset[int]:
        out, todo = set(states), list(states)
        while todo:
            i = todo.pop()
            for j in self.states[i][1] if i < self.end else ():
                if j not in out:
                    out.add(j)
                    todo.append(j)
        return frozenset(out)

    def longest(self, words: list[bytes], at: int) -> int:
        """Where the longest match that starts at word `at` ends, or -1: all mandatory wording, in order."""
        live, end = self.start, -1
        while True:
            if self.end in live:
                end = at
            if at >= len(words):
                return end
            word = words[at]
            live = self._closed({i + 1 for i in live if i < self.end and self.states[i][0] in (None, word)})
            if not live:
                return end
            at += 1


def scan_texts(
    texts: list[str], phrases: dict[str, str], templates: dict[str, str], openings: dict[str, str]
) -> list[tuple]:
    """(n_words, n_base, first, last, base labels, labels, score) of each text."""
    wanted = [(tuple(p.encode().split()), label) for p, label in phrases.items()]
    automata = [(Automaton(t), label) for label, t in {**templates, **openings}.items()]
    starts: dict[bytes, list[tuple[tuple[bytes, ...], str]]] = {}
    for words, label in wanted:
        starts.setdefault(words[0], []).append((words, label))
    begins: dict[bytes, list[tuple[Automaton, str]]] = {}
    for automaton, label in automata:
        for word in automaton.first:
            begins.setdefault(word, []).append((automaton, label))
    anchors = re.compile(rb"(?<![^ ])(?:" + b"|".join(map(re.escape, {*starts, *begins})) + rb")(?![^ ])")
    out = []
    for text in texts:
        spaced = text.encode("utf-8", "surrogatepass").translate(_KEEP)
        if not anchors.search(spaced):
            out.append((len(spaced.split()), 0, None, None, "", "", 0.0))
            continue
        words = spaced.split()
        places, base, more = [], set(), set()
        for i, word in enumerate(words):
            for phrase, label in starts.get(word, ()):
                if tuple(words[i : i + len(phrase)]) == phrase:
                    places.append(i)
                    base.add(label)
            ends = [(automaton.longest(words, i), label) for automaton, label in begins.get(word, ())]
            farthest = max(ends, default=(-1,))[0]
            more |= {label for end, label in ends if end == farthest >= 0}
        score = 1.0 if more - openings.keys() else 0.6 if base else 0.0
        first, last = (min(places), max(places)) if places else (None, None)
        labels = ",".join(sorted(base | more))
        out.append((len(words), len(places), first, last, ",".join(sorted(base)), labels, score))
    return out


COLUMNS = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double"
)


def scan(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, str] = TEMPLATES,
    openings: dict[str, str] = OPENINGS,
) -> DataFrame:
    """What the phrases and the templates find in every text."""
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                body = [x.as_py() or "" for x in part.column(1)]
                found = scan_texts(body, phrases, templates, openings)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(zip(*found), kinds))], names
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, COLUMNS)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
