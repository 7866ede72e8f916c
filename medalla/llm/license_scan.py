"""Licence scan by template-markup matching.

A template is the wording of a licence or notice with markup: optional
regions and replaceable ones. Each is compiled into an automaton over words;
a place of a document matches if the automaton accepts it there, so every
mandatory word is matched exactly, in order, with nothing between.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Phrases and labels of the base scan.
PHRASES = {
    "gpl": "gnu general public license",
    "apache": "apache license",
    "cc-by": "cc by",
    "mit": "mit license",
}

_BSD = ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met <<opt>>1<<end>> redistributions of source code must retain the above copyright "
        "notice this list of conditions and the following disclaimer <<opt>>2<<end>> redistributions in binary form must "
        "reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation "
        "and or other materials provided with the distribution ")
_BSD_DISCLAIMER = (
    "this software is provided by <<var 12>> as is and any express or implied warranties including but not limited to "
    "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall "
    "<<var 12>> be liable for any direct indirect incidental special exemplary or consequential damages including but "
    "not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
    "however caused and on any theory of liability whether in contract strict liability or tort including negligence or "
    "otherwise arising in any way out of the use of this software even if advised of the possibility of such damage")
_GPL_START = "<<opt>>this <<var 6>> is free software you can<<end>> redistribute it and or modify it under the terms of "
_GPL_REST = (
    " <<opt>>this <<var 6>> is distributed in the hope that it will be useful but without any warranty without even the "
    "implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more "
    "details <<opt>>you should have received a copy of the gnu general public license along with <<var 6>> if not "
    "<<opt>>see <<opt>>http<<end>> <<opt>>https<<end>> www gnu org licenses<<end>> "
    "<<opt>>write to the free software foundation <<opt>>inc<<end>><<end>><<end>><<end>>")


def _gpl_headers(version: int) -> dict[str, str]:
    """The notices of the Free Software Foundation, with the version after
    or before its name."""
    return {
        f"gpl-{version}.0-header": f"{_GPL_START}the gnu general public license as published by <<var 6>> "
                                   f"<<opt>>either<<end>> version {version} <<opt>>of the license<<end>> <<opt>>only<<end>> "
                                   f"<<opt>>or at your option any later version<<end>>{_GPL_REST}",
        f"gpl-{version}.0-header-fixed": f"{_GPL_START}the gnu general public license version {version} <<opt>>only<<end>> "
                                         f"<<opt>>as published by the free software foundation<<end>>{_GPL_REST}",
        f"gpl-{version}.0-header-of": f"{_GPL_START}version {version} of the gnu general public license <<opt>>as published "
                                      f"by the free software foundation<<end>>{_GPL_REST}",
    }


def _creative_commons() -> dict[str, str]:
    """Names and addresses of the six licences in version 4.0, and the short
    forms that are not below."""
    names = {"by": [""], "by-sa": ["sharealike", "share alike"], "by-nc": ["noncommercial", "non commercial"],
             "by-nd": ["noderivatives", "noderivs"], "by-nc-sa": ["noncommercial sharealike", "non commercial share alike"],
             "by-nc-nd": ["noncommercial noderivatives", "noncommercial noderivs"]}
    out = {}
    for short, wordings in names.items():
        for i, w in enumerate(wordings):
            out[f"cc-{short}-4.0-name" + "-other" * i] = (
                f"creative commons attribution {w} 4.0 <<opt>>international<<end>> <<opt>>public<<end>> <<opt>>license<<end>>")
        out[f"cc-{short}-4.0-url"] = f"creativecommons org licenses {short} 4.0"
        if short in ("by-nd", "by-nc-sa", "by-nc-nd"):
            out[f"cc-{short}-4.0"] = (f"licensed under <<opt>>a<<end>> <<opt>>the<<end>> cc {short} 4.0 "
                                      "<<opt>>international license<<end>>")
    return out


# Wording of public licences and notices. <<opt>> ... <<end>>
# may be absent; <<var n>> stands for up to n words of any kind.
TEMPLATES = {
    "gpl-2.0": "<<opt>>this <<var 6>> is<<end>> licensed under the <<opt>>terms of the<<end>> gnu general public "
               "license <<opt>>as published by the free software foundation<<end>> <<opt>>either<<end>> version 2",
    "gpl-3.0": "<<opt>>this <<var 6>> is<<end>> licensed under the <<opt>>terms of the<<end>> gnu general public "
               "license <<opt>>as published by the free software foundation<<end>> <<opt>>either<<end>> version 3",
    "apache-2.0": "licensed under the apache license version 2.0 <<opt>>the license you may not use this file except "
                  "in compliance with the license you may obtain a copy of the license at <<var 8>> <<opt>>unless "
                  "required by applicable law or agreed to in writing software distributed under the license is "
                  "distributed on an as is basis without warranties or conditions of any kind either express or implied "
                  "see the license for the specific language governing permissions and limitations under the "
                  "license<<end>><<end>>",
    "cc-by-4.0": "licensed under <<opt>>a<<end>> <<opt>>the<<end>> cc by 4.0 <<opt>>international license<<end>>",
    "cc-by-sa-4.0": "licensed under <<opt>>a<<end>> <<opt>>the<<end>> cc by sa 4.0 <<opt>>international license<<end>>",
    "cc-by-nc-4.0": "licensed under <<opt>>a<<end>> <<opt>>the<<end>> cc by nc 4.0 <<opt>>international license<<end>>",
    "mit-notice": "<<opt>>released<<end>> <<opt>>licensed<<end>> under the mit license",
    "mit-text": "<<opt>>the mit license<<end>> <<opt>>mit license<<end>> <<opt>>copyright c <<var 12>><<end>> permission "
                "is hereby granted free of charge to any person obtaining a copy of this software and associated "
                "documentation files the software to deal in the software without restriction including without "
                "limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of "
                "the software and to permit persons to whom the software is furnished to do so subject to the "
                "following conditions the above copyright notice and this permission notice <<opt>>including the next "
                "paragraph<<end>> shall be included in all copies or substantial portions of the software the software "
                "is provided as is without warranty of any kind express or implied including but not limited to the "
                "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall "
                "<<var 12>> be liable for any claim damages or other liability whether in an action of contract tort "
                "or otherwise arising from out of or in connection with the software or the use or other dealings in "
                "the software",
    "isc": "permission to use copy modify <<opt>>and<<end>> <<opt>>or<<end>> distribute this software for any purpose "
           "with or without fee is hereby granted provided that the above copyright notice and this permission notice "
           "appear in all copies the software is provided as is and <<var 8>> disclaims all warranties with regard to "
           "this software including all implied warranties of merchantability and fitness in no event shall <<var 8>> "
           "be liable for any special direct indirect or consequential damages or any damages whatsoever resulting "
           "from loss of use data or profits whether in an action of contract negligence or other tortious action "
           "arising out of or in connection with the use or performance of this software",
    "bsd-2-clause": _BSD + _BSD_DISCLAIMER,
    "bsd-3-clause": _BSD + "<<opt>>3<<end>> neither the name of <<var 12>> nor the names of <<var 8>> may be used to "
                    "endorse or promote products derived from this software without specific prior written permission "
                    + _BSD_DISCLAIMER,
    "all-rights-reserved": "<<opt>>copyright <<opt>>c<<end>> <<var 8>><<end>> all rights reserved",
    **_gpl_headers(2),
    **_gpl_headers(3),
    **_creative_commons(),
}

_OTHER = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else 0x20 for c in range(256))


def words(text: str) -> list[bytes]:
    """The words of a text: A-Z lowered, then runs of a-z, 0-9 and anything
    beyond ASCII."""
    return text.encode().lower().translate(_OTHER).split()


class Automaton(NamedTuple):
    """States are numbers; ``step[s]`` maps a word to the next state, None
    (any word) included; ``skip[s]`` are the states reached without a word."""

    label: str
    step: list[dict[bytes | None, int]]
    skip: list[list[int]]
    end: int
    first: frozenset[bytes]
    anchor: bytes

    def closure(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return out

    def match(self, text: list[bytes], at: int) -> int:
        """End of the longest match that starts at word ``at``, or -1."""
        states, best = self.closure({0}), -1
        for i in range(at, len(text)):
            states = {t for s in states for key in (text[i], None) if (t := self.step[s].get(key)) is not None}
            if not states:
                break
            states = self.closure(states)
            if self.end in states:
                best = i + 1
        return best


def compile_template(label: str, markup: str) -> Automaton:
    """``markup`` as an automaton. A template must have a mandatory word."""
    step: list[dict] = [{}]
    skip: list[list[int]] = [[]]

    def state() -> int:
        step.append({})
        skip.append([])
        return len(step) - 1

    here, opened, mandatory = 0, [], []
    for token in re.findall(r"<<opt>>|<<end>>|<<var \d+>>|[^<]+", markup):
        if token == "<<opt>>":
            opened.append(here)
        elif token == "<<end>>":
            skip[opened.pop()].append(here)
        elif token.startswith("<<var"):
            ends, at = [here], here
            for _ in range(int(token[6:-2])):
                nxt = state()
                step[at][None] = nxt
                ends.append(at := nxt)
            here = state()
            for e in ends:
                skip[e].append(here)
        else:
            for w in words(token):
                # a fresh state, so a word edge never joins one that is there
                new, at = state(), state()
                skip[here].append(at)
                step[at][w] = new
                here = new
                if not opened:
                    mandatory.append(w)
    if opened or not mandatory:
        raise ValueError(f"template {label}: open region or no mandatory word")
    a = Automaton(label, step, skip, here, frozenset(), max(mandatory, key=len))
    start = a.closure({0})
    if any(None in step[s] for s in start):
        raise ValueError(f"template {label}: it starts with a replaceable region")
    return a._replace(first=frozenset(w for s in start for w in step[s]))


@functools.cache
def _compiled(templates: tuple[tuple[str, str], ...]) -> list[Automaton]:
    return [compile_template(*t) for t in templates]


def scan(docs: DataFrame, templates: Mapping[str, str], labels: str = "matches") -> DataFrame:
    """``docs`` with ``n_words`` and an array ``matches`` of (label, start,
    end): every place, words counted from 0, where a template's automaton
    accepts, the longest match of each start; places of one template may
    overlap.

    A narrow pass over whole texts with nothing shuffled. Null text has no
    words; a text is split into words one document at a time. Columns named
    n_words or as ``labels`` are replaced, all others kept.
    """
    pairs = tuple(templates.items())
    keep = docs.drop("n_words", labels)
    out = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("found", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType())])))])

    @F.pandas_udf(out)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automata = _compiled(pairs)
        for texts in batches:
            rows = []
            for text in texts:
                w = words(text or "")
                present = set(w)
                found = []
                for a in automata:
                    if a.anchor in present:
                        found += [(a.label, i, e) for i, x in enumerate(w) if x in a.first
                                  and (e := a.match(w, i)) >= 0]
                rows.append((len(w), sorted(found, key=lambda m: (m[1], m[0]))))
            yield pd.DataFrame({"n_words": [r[0] for r in rows],
                                "found": [[{"label": l, "start": s, "end": e} for l, s, e in r[1]] for r in rows]})

    r = keep.withColumn("_scan", find("text"))
    return r.withColumns({"n_words": F.col("_scan.n_words"), labels: F.col("_scan.found")}).drop("_scan")
