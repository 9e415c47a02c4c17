"""Operators on documents, against brute force on tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import random
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourlake.llm import licences, line_dedup, minhash, mixing, queries

SCHEMA = "doc_id long, text string, source string, digest string, block long, line string, n long, root string, words string, _key string, licence_scan string, removed string"
#: Names that the operators give to columns of their own.
CLASHES = ["_gone", "_removed", "_hash", "_kept", "_row", "_mix", "_copy", "_size", "_source", "_facts", "_place", "_toxicity", "_dh_id", "_dh_hash", "_kept_id", "doc", "dh", "text_hash", "component_id", "kept", "part", "rows", "taken", "size", "key", "mix", "id"]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, s, *[None, 3, "x", None, "y", "z", "k", "l", "r"], *CLASHES) for i, t, s in rows], SCHEMA + "".join(f", `{c}` string" for c in CLASHES))


def corpus(seed=1, n=60):
    """Rows with copies, near copies of texts and lines, and the odd cases."""
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["the", "of", "and"] * 40
    lines = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 2, 3, 4, 5, 12, 30, 45]))) for _ in range(n)]

    def varied(line):
        words = line.split()
        for _ in range(rnd.randint(0, 1 + len(words) // 12)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        return " ".join(words)

    rows = []
    for k in range(n):
        text = "\n".join(varied(rnd.choice(lines)) if rnd.random() < 0.5 else " ".join(rnd.choice(vocabulary) for _ in range(25)) for _ in range(rnd.randint(1, 8)))
        rows.append((k, text, rnd.choice(["a", "b", None, "é"])))
    for k in range(n, n + 30):
        words = rows[rnd.randrange(20)][1].split(" ")
        for _ in range(rnd.randint(0, 1 + len(words) // 20)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        rows.append((k, " ".join(words), "b"))
    long = " ".join(rnd.choice(vocabulary) for _ in range(40000))
    rows += [(200, None, None), (201, "", "a"), (202, "one", "a"), (203, " \n\t ", "a"), (204, "one", None), (205, long, "a"), (206, long + " more", "a"), (None, rows[3][1], "a"), (None, "only here", None)]
    rows += [rows[5], rows[5], (207, "One\r\nTWO three", "b"), (208, "one two\x0bTHREE", "b")]
    return rows


def words_of(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = words_of(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k, threshold=80):
    """Least reachable id by set of shingles."""
    sets = list({frozenset(shingles(t, k)) for _, t, _ in rows} - {frozenset()})
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for i, t, _ in rows:
        s = frozenset(shingles(t, k))
        if s and i is not None:
            r = find(sets.index(s))
            least[r] = min(least.get(r, i), i)
    return {s: least.get(find(a)) for a, s in enumerate(sets)}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, k):
    rows = corpus()
    want = brute_components(rows, k)
    got = minhash.near_duplicates(documents(spark, rows), k).collect()
    expected = []
    for i, t, _ in rows:
        s = frozenset(shingles(t, k))
        component = want[s] if s else i
        expected.append((i, len(s), component, i == component))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r[:4])) for r in got)
    kept = minhash.deduplicated(documents(spark, rows), k)
    assert kept.columns == documents(spark, rows).columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"] is not None]
    assert sorted(ids) == sorted({e[0] for e in expected if e[3] and e[0] is not None})


def test_many_near_copies_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 5)
    rnd = random.Random(4)
    base = [f"x{k}" for k in range(60)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(60)] = f"y{rnd.randrange(10**6)}"
        rows.append((i, " ".join(words), "a"))
    want = brute_components(rows, 2)
    got = minhash.near_duplicates(documents(spark, rows), 2).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: want[frozenset(shingles(t, 2))] for i, t, _ in rows}


def test_estimates_are_near_the_index():
    rnd = random.Random(5)
    a = [f"a{k}" for k in range(2000)]
    b = a[:1600] + [f"b{rnd.random()}" for _ in range(400)]
    left, right = (minhash.sketch(minhash.shingle_set(" ".join(x), 1))[None] for x in (a, b))
    assert abs(minhash.estimates(left, right)[0, 0] - 1600 / 2400) < 4 * 0.042
    assert minhash.sketch(minhash.shingle_set("", 2)).tolist() == [minhash.EMPTY] * minhash.REGISTERS


def agreeing(same):
    """Two rows of full registers of which `same` agree."""
    left = np.arange(minhash.REGISTERS, dtype=np.uint16)[None]
    right = left.copy()
    right[0, same:] += 1000
    return left, right


def test_the_estimate_loses_no_more_pairs_than_the_bands():
    n, j = minhash.REGISTERS, 0.8
    lost = sum(comb(n, k) * j**k * (1 - j) ** (n - k) for k in range(n) if minhash.estimates(*agreeing(k))[0, 0] < minhash.least_estimate(80))
    assert lost <= (1 - j**minhash.BAND) ** (n // minhash.BAND)


def test_a_pair_with_few_agreeing_registers_is_a_candidate(spark):
    left, right = agreeing(80)  # 80 of 128 at an index of 0.8: rare, but far from impossible
    rows = [(bytearray(name), bytearray(r.tobytes()), minhash.band_keys(r[0]).view(np.int64).tolist()) for name, r in ((b"a", left), (b"b", right))]
    found = minhash.candidate_links(spark.createDataFrame(rows, "digest binary, registers binary, keys array<long>"), 80).collect()
    assert {frozenset((bytes(r["a"]), bytes(r["b"]))) for r in found} == {frozenset((b"a", b"b"))}


@pytest.mark.parametrize("union", [5, 10, 15, 20, 35, 60, 100, 125, 130, 155, 160, 200, 400, 1000])
def test_pairs_at_the_threshold_are_candidates(union):
    """Of thousands of pairs of sets with a Jaccard index of exactly 0.8, of any size, all share a key and none has too low an estimate."""
    rng = np.random.default_rng(union)
    lost = 0
    for _ in range(1500 if union < 300 else 300):
        h = np.unique(rng.integers(0, 1 << 64, union, np.uint64, endpoint=False))
        shared, rest = h[rng.permutation(len(h))[: union * 4 // 5]], None
        rest = np.setdiff1d(h, shared)
        cut = rng.integers(0, len(rest) + 1)
        sets = [np.sort(np.concatenate([shared, r])) for r in (rest[:cut], rest[cut:])]
        registers = [minhash.sketch(s) for s in sets]
        keys = [set(minhash.keys_of(s, r, 80).tolist()) for s, r in zip(sets, registers, strict=True)]
        lost += not keys[0] & keys[1] or minhash.estimates(registers[0][None], registers[1][None])[0, 0] < minhash.least_estimate(80)
    assert lost == 0


def brute_lines(rows):
    order = lambda r: (r[0] is not None, r[0] or 0, r[2])
    docs = sorted({(i, t or "", h) for i, t, h in rows}, key=order)
    seen, out = [], {}
    for i, t, h in docs:
        gone, n = [], 0
        for k, line in enumerate(t.encode().lower().split(b"\n")):
            s = frozenset(line.split())
            if s:
                n += 1
                if any(100 * len(s & o) >= 80 * len(s | o) for o in seen):
                    gone.append(k)
                seen.append(s)
        out[i, t] = n, gone
    return out


def test_line_dedup(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HEAVY", 7)
    monkeypatch.setattr(line_dedup, "FIRST", 1)
    rows = corpus(2)
    df = documents(spark, rows)
    hashed = df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    want = brute_lines([tuple(r) for r in hashed])
    texts = {(r["doc_id"], r["h"]): r["text"] or "" for r in hashed}
    got = {(r["doc_id"], texts[r["doc_id"], r["dh"]]): (r["n_lines"], r["removed"]) for r in line_dedup.decisions(df).collect()}
    assert got == {k: v for k, v in want.items() if v[0]}
    assert sum(len(v[1]) for v in want.values()) > 50
    out = line_dedup.dedup_lines(df, removed="removed")
    assert out.count() == len(rows) and set(out.columns) == set(df.columns)
    cut = {(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()}
    for i, t, _ in rows:
        n, gone = want[i, t or ""]
        assert (i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)) in cut
    assert line_dedup.dedup_lines(df).count() == sum(1 for i, t, _ in rows if not want[i, t or ""][1] or len(want[i, t or ""][1]) < want[i, t or ""][0])


def test_mixing(spark):
    rows = corpus(3)
    got = mixing.mix(documents(spark, rows)).select("doc_id", "source", "text", "mix.*").collect()
    again = mixing.mix(documents(spark, rows)).select("doc_id", "source", "text", "mix.*").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words_of(t))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while free and left > 1e-9:  # share, stop at three times the size, share the excess again
        share = {s: left * weights[s] / sum(weights[f] for f in free) for s in free}
        for s in list(free):
            target[s] = min(3.0 * sizes[s], target[s] + share[s])
            if target[s] >= 3 * sizes[s] - 1e-9:
                free.discard(s)
        left = sum(sizes.values()) - sum(target.values())
    taken = dict.fromkeys(names, 0)
    for r in got:
        assert r["size"] == len(words_of(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - target[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["times"] * r["size"]
        taken[r["source"]] += r["taken"]
    for s in names:
        longest = max(len(words_of(t)) for _, t, o in rows if o == s)
        assert abs(taken[s] - target[s]) <= longest / 2 + 1e-6
        times = [r["times"] for r in got if r["source"] == s and r["size"]]
        assert max(times) - min(times) <= 1  # complete epochs first
    copies = mixing.mixed_documents(documents(spark, rows))
    assert copies.count() == sum(r["times"] for r in got) and copies.columns == documents(spark, rows).columns


@pytest.mark.parametrize("few", [50_000, 1])
def test_mixing_narrows_in_on_the_cut(spark, monkeypatch, few):
    """Whatever the rows that may be sorted together, and with many repeated rows, the mix is that of one running sum."""
    import duckdb
    import pandas as pd

    monkeypatch.setattr(mixing, "FEW_ROWS", few)
    rnd = random.Random(few)
    rows = [(k if rnd.random() < 0.9 else rnd.randrange(30), " ".join(["x"] * rnd.choice([0, 1, 1, 2, 3, 10, 50])), rnd.choice(["a", "b", "c", None])) for k in range(1500)]
    rows += [(7, "w w w", "e")] * 300 + [(8, "w w w", "f")] * 1500
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken").collect()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]))
    want = con.execute(queries.ORACLE["op3_mixing"]).fetchall()
    rounded = lambda out: sorted((*r[:3], round(r[3], 6), r[4]) for r in out)
    assert rounded(got) == rounded(want)


def test_licences(spark):
    rows = [
        (1, "x\nReleased under the MIT License.\ny", "a"),
        (2, "// Licensed under the Apache License,\n// Version 2.0.\n", "a"),
        (3, "This work is licensed under the GNU General Public License, version 3. Licensed under CC BY-NC 4.0.", "a"),
        (4, "some unknown license text", "a"),
        (5, None, None),
        (6, "", None),
        (7, "mit licence? no " * 20000, "a"),
        (1, "x\nReleased under the MIT License.\ny", "a"),
        (8, "Permission is hereby granted, free of charge\n\nAll rights reserved.", "b"),
    ]
    df = documents(spark, rows)
    got = {r["doc_id"]: r for r in licences.scan(df).select("doc_id", "licence_scan.*").collect()}
    assert got[1]["licences"] == ["MIT"] and got[2]["licences"] == ["Apache-2.0"] and got[3]["licences"] == ["CC-BY-NC-4.0", "GPL-3.0"]
    assert got[4]["licences"] == [] and got[4]["unknown"] == 1 and got[8]["licences"] == ["All-Rights-Reserved"]
    assert got[5]["licences"] == got[6]["licences"] == got[7]["licences"] == []
    assert licences.scan(df).count() == len(rows)
    assert all(any(a in s for a in licences.ANCHORS) for s in licences.SENTENCES.values())
    assert {i for run, _ in licences.RULES for i in run} <= set(licences.SENTENCES)


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{comma} either version {version} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program{end}
"""
GPL3 = GPL.format(mark=":", comma=",", version=3, end=".  If not, see <https://www.gnu.org/licenses/>.")
GPL2 = GPL.format(mark=";", comma=";", version=2, end="; if not, write to the Free Software\nFoundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.")
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
SPDX = {"MIT": "MIT", "Apache-2.0": "Apache-2.0", "GPL-3.0-only": "GPL-3.0-only", "GPL-3.0-or-later": "GPL-3.0-or-later", "GPL-2.0-only": "GPL-2.0-only", "BSD-3-Clause": "BSD-3-Clause", "MPL-2.0": "MPL-2.0"}


MIT = """MIT License

Copyright (c) 2020 Some Holder

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Copyright (c) 2020, Some Holder
All rights reserved{end}

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{more}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE.
"""
NAME = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ISC = """ISC License

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS.
"""


def test_licences_of_whole_texts(spark):
    """Texts of licences, with a holder's lines between their sentences, are named by their SPDX identifiers."""
    texts = [(MIT, {"MIT"}), (BSD.format(end=".", more=NAME), {"BSD-3-Clause"}), (BSD.format(end=".", more=""), {"BSD-2-Clause"}), (ISC, {"ISC"})]
    texts += [("\n".join(f" * {x}".rstrip() for x in t.splitlines()), n) for t, n in texts[:1]]
    df = documents(spark, [(k, t, "a") for k, (t, _) in enumerate(texts)])
    got = {r["doc_id"]: set(r["licences"]) - {"All-Rights-Reserved"} for r in licences.scan(df).select("doc_id", "licence_scan.*").collect()}
    assert got == {k: n for k, (_, n) in enumerate(texts)}
    assert len(set(licences.SENTENCES.values())) == len(licences.SENTENCES)
    assert {n for _, n in licences.RULES} - {"All-Rights-Reserved", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"} <= set(licences.SPDX)


def test_licences_of_the_standard_notices(spark):
    notices = [(APACHE, "Apache-2.0"), (GPL3, "GPL-3.0-or-later"), (GPL2, "GPL-2.0-or-later"), (LGPL, "LGPL-2.1-or-later"), (MPL, "MPL-2.0")]
    # the parts that each notice names first, alone
    notices += [("\n\n".join(t.split("\n\n")[:1]), n) for t, n in notices] + [(MPL.split(" If")[0], "MPL-2.0")]
    texts = [(t, n) for t, n in notices]
    texts += [(" ".join(t.split()), n) for t, n in notices]  # on one line
    texts += [("\n".join(f"# {x}".rstrip() for x in t.splitlines()) + "\n", n) for t, n in notices]  # as a comment
    texts += [(f"{a}SPDX-License-Identifier: {t}{z}", n) for t, n in SPDX.items() for a, z in (("", ""), ("# ", "\nimport os\n"), ("<!-- ", " -->\n"))]
    df = documents(spark, [(k, t, "a") for k, (t, _) in enumerate(texts)] + [(len(texts), "mit\nlicence\n2.0", "a")])
    got = {r["doc_id"]: r for r in licences.scan(df).select("doc_id", "licence_scan.*").collect()}
    assert {k: got[k]["licences"] for k in range(len(texts))} == {k: [n] for k, (_, n) in enumerate(texts)}
    assert got[0]["sentences"] == ["apacheHead", "apacheNotUse", "apacheCopy", "apacheUrl", "apacheAsIs", "apacheSee"]
    assert got[1]["sentences"] == ["gplTerms3", "gplUseful", "gplImplied", "gplSee", "gplCopy"]
    assert got[4]["sentences"] == ["mplForm", "mplCopy"]
    assert got[len(texts)]["sentences"] == [] and got[len(texts)]["licences"] == []


@pytest.mark.parametrize("run", [line_dedup.dedup_lines, minhash.deduplicated, mixing.mixed_documents])
def test_columns_of_any_name_pass_through(spark, run):
    df = documents(spark, corpus(5)[:30])
    out = run(df)
    assert out.columns == df.columns
    for row in out.collect():
        assert [row[c] for c in CLASHES] == CLASHES and row["block"] == 3


def test_ids_that_are_no_numbers_and_ids_with_several_texts(spark):
    rows = [("b", "one two three four five six", 0), ("a", "one two three four five six", 0), ("a", "seven\none two three four five six", 0), (None, "seven", 0)]
    for kind in ("string", "long"):
        ids = {"a": 1, "b": 2, None: None} if kind == "long" else {"a": "a", "b": "b", None: None}
        df = spark.createDataFrame([(ids[i], t) for i, t, _ in rows], f"doc_id {kind}, text string")
        order = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
        texts = {h: t for t, h in order.items()}
        want = brute_lines([(({None: None, "a": 1, "b": 2}[i]), t, order[t]) for i, t, _ in rows])
        got = {({v: {"a": 1, "b": 2}.get(k) for k, v in ids.items()}[r["doc_id"]], texts[r["dh"]]): (r["n_lines"], r["removed"]) for r in line_dedup.decisions(df).collect()}
        assert got == want


@pytest.mark.parametrize("run", [lambda d: minhash.near_duplicates(d), minhash.deduplicated, line_dedup.decisions, line_dedup.dedup_lines, mixing.mix, mixing.mixed_documents, licences.scan])
def test_empty_tables(spark, run):
    assert run(documents(spark, []).limit(0)).count() == 0


NATIVE = ("op3_mixing", "op9_licences")


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans(spark, name):
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("name", ["op3_mixing", "op6_minhash", "op7_warc", "op8_line_dedup", "op9_licences", "op4_embedding_dedup"])
def test_query_equals_its_sql(spark, duck, same, name):
    df = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    same((df.columns, [tuple(r) for r in df.collect()]), duck(queries.ORACLE[name], "sf0.001"))


def test_op8_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.lit(0)).collect()
    want = brute_lines([tuple(r) for r in docs])
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["removed_lines"]) for r in queries.QUERIES["op8_line_dedup"](spark, sf).collect()}
    assert got == {i: (n, len(g), ",".join(map(str, g))) for (i, _), (n, g) in want.items()}
