"""Operators over documents against brute force, on awkward and on empty tables."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import license_scan, mixing, ngram_join, packing, suffix_dedup, token_counts, toxicity
from mercato.llm.shared import tokenizer_path
from tests.llm.conftest import awkward, prose


def test_pieces_and_packing(documents):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")).encode
    table = awkward()
    got = packing.pack_documents(documents(*table), with_ids=True).collect()
    expected = []
    for doc_id, text in table:
        ids = [*encode(text or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[at : at + 4096], "<u4").tobytes()
            expected.append((str(doc_id), n, at, len(part) // 4, zlib.crc32(part)))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(expected)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 4096) + 1


def test_plan_is_best_fit_decreasing():
    """The counted plan fills the bins that one-by-one best fit fills."""
    law = np.random.default_rng(0)
    for capacity in (7, 30, 100):
        lengths = law.integers(1, capacity + 1, 400).tolist()
        counts = {n: lengths.count(n) for n in set(lengths)}
        rooms = []
        for n in sorted(lengths, reverse=True):
            fitting = [(room, i) for i, room in enumerate(rooms) if room >= n]
            if fitting:
                rooms[min(fitting)[1]] -= n
            else:
                rooms.append(capacity - n)
        filled, placed = {}, 0
        for length, _, n, first, per_bin, offset in packing.best_fit_plan(counts, capacity):
            placed += n
            for j in range(n):
                at = first + j // per_bin
                assert filled.get(at, 0) == offset + j % per_bin * length
                filled[at] = filled.get(at, 0) + length
        assert placed == len(lengths)
        assert sorted(capacity - v for v in filled.values()) == sorted(rooms)


def test_token_counts(documents):
    import sentencepiece

    encode = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model")).encode
    table = awkward()
    expected = sorted((str(i), len((t or "").encode()), len(encode(t or ""))) for i, t in table)
    for chunk in (1 << 16, 100):
        got = token_counts.token_counts(documents(*table), chunk=chunk).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == expected
        assert all(r.over_limit == (r.n_tokens > 4096) for r in got)


def test_state_maps_compose_at_any_cut():
    import random

    counter = token_counts.TokenCounter("piece_bpe_32k.model")
    draw = random.Random(4)
    parts = ["a", "the", "ing", " ", "  ", "\n", "é", "漢", "😀", "1", "tion", "zq", "<s>"]
    for _ in range(300):
        text = token_counts.SPACE + "".join(draw.choices(parts, k=40)).replace(" ", token_counts.SPACE)
        whole = counter.spaced(text)
        cuts = [0, draw.randrange(17, 30), len(text)]
        if len(text) - cuts[1] < 17:
            continue
        maps = [counter.state_map(text, a, b) for a, b in zip(cuts, cuts[1:])]
        assert [link[4] for link in token_counts.scan(maps)] == [whole]


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def edited(text, seed, edits):
    import random

    draw = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"edit{draw.randrange(10**6)}"
    return " ".join(words)


def test_ngram_join(documents):
    """Chains of near copies of one text, a common passage, awkward texts: all components."""
    base, passage = prose(200, 5), prose(60, 6)
    table = awkward() + [(100 + i, edited(base, i, i % 9)) for i in range(60)]
    table += [(200 + i, passage + " " + prose(20 + 5 * i, 300 + i)) for i in range(30)]
    table += [(300 + i, edited(passage, i, 1 + i % 2)) for i in range(20)]
    # filled by the passage to between three quarters and nine tenths: late and early tokens
    table += [(400 + i, passage + " " + prose(3 + i % 16, 700 + i)) for i in range(48)]
    sets = [shingle_set(t) for _, t in table]
    part = list(range(len(table)))
    for i in range(len(table)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                old, new = part[i], part[j]
                part = [new if p == old else p for p in part]
    expected = []
    for i, (doc_id, _) in enumerate(table):
        ids = [table[j][0] for j in range(len(table)) if part[j] == part[i] and table[j][0] is not None]
        expected.append((str(doc_id), len(sets[i]), min(ids) if sets[i] else doc_id))
    got = ngram_join.joined(documents(*table)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == sorted(expected)


def windows(table, length):
    seen = {}
    for data in table:
        for i in range(len(data) - length + 1):
            key = data[i : i + length]
            seen[key] = seen.get(key, 0) + 1
    return seen


@pytest.mark.parametrize("length", [400, 40])
def test_suffix_dedup(documents, length):
    shared = prose(80, 8)
    table = [(i, t if t is None else t[:6000]) for i, t in awkward()]
    table += [(50 + i, f"{prose(30, 20 + i)} {shared} {prose(30, 40 + i)}") for i in range(6)]
    table += [(70, "line of words again\n" * 60), (71, shared[: length - 1]), (72, shared[:length])]
    data = [(t or "").encode() for _, t in table]
    seen = windows(data, length)
    expected = []
    for (doc_id, _), own in zip(table, data):
        gone = np.zeros(len(own), bool)
        for i in range(len(own) - length + 1):
            if seen[own[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(own, gone) if not g)
        expected.append((str(doc_id), len(own), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.digest(documents(*table), length=length).collect()
    assert sorted(
        (str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got
    ) == sorted(expected)


def test_an_anchor_dealt_to_many_tasks_gives_the_same(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ENTRIES", 2)
    test_suffix_dedup(documents, 64)


def test_words_in_repeated_passages_are_counted(llm, documents, tmp_path):
    passage = " ".join(f"w{i}" for i in range(51))
    table = [(i, f"{prose(30, i)} {passage} {prose(20, 20 + i)}") for i in (1, 2)]
    table += [(3, prose(70, 3)), (4, f"{prose(9, 4)}\n{passage.replace(' ', '  ')}"), (5, None), (6, passage[:-4])]
    table += [(i, "x" * 450 + str(i)) for i in (7, 8)] + [(9, prose(60, 9))] * 2 + [(10, "v " * 60)]
    documents(*table).write.parquet(str(tmp_path / "documents.parquet"))
    got = suffix_dedup.op10_suffix_dedup(llm, str(tmp_path))
    assert got.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = {r.doc_id: r for r in got.collect()}
    counts = {i: r.n_repeated_words for i, r in found.items()}
    assert counts == {1: 51, 2: 51, 3: 0, 4: 51, 5: 0, 6: 0, 7: 0, 8: 0, 9: 60, 10: 60}
    assert found[1].n_removed == 0 and found[7].n_removed > 0


def test_suffix_levels_stay_logarithmic():
    family, law, seen, told = suffix_dedup.SuffixLevels(), np.random.default_rng(1), {}, set()
    for batch in range(40):
        keys = law.integers(0, 3000, 50).astype(np.uint64)
        own = np.arange(50) + 50 * batch
        owner, _ = family.add(keys, own, np.zeros(50, np.int32), np.zeros(50, bool))
        told |= set(owner.tolist())
        for k, o in zip(keys.tolist(), own.tolist()):
            seen.setdefault(k, []).append(o)
        assert len(family.levels) <= 12
    assert told == {o for found in seen.values() if len(found) > 1 for o in found}


def targets(sizes, weights, most):
    """Shares by hand: cap what is above, reshare, until none is above."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    free, out = set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        left = sum(sizes) - sum(most * s for i, s in enumerate(sizes) if i not in free)
        unit = sum(weight[i] for i in free)
        over = {i for i in free if left * weight[i] > most * sizes[i] * unit}
        for i in over or free:
            out[i] = float(most * sizes[i]) if over else left * weight[i] / unit
        if not over:
            break
        free -= over
    return out


def targets_by_spark(llm, sizes, weights, most):
    table = llm.createDataFrame(list(enumerate(sizes)), "number long, source_size long")
    rows = mixing.with_targets(table, weights, most).orderBy("number").collect()
    return [r.target for r in rows]


def test_mixing(documents):
    table = [(i, prose(5 + i % 40, i), ["a", "b", "c", None][i % 4]) for i in range(400)]
    table += [(1000, None, "a"), (1001, "", "d"), (1002, "w", "d"), (1002, "w", "d")]
    taken = mixing.draws(documents(*table), block_docs=16, shards=5)
    got = taken.collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted((i, len((t or "").split())) for i, t, _ in table)
    again = mixing.draws(documents(*table).coalesce(1), block_docs=16, shards=5).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    by_source = {}
    for r in got:
        assert len(r.draws) <= 3 and len({d.epoch for d in r.draws}) == len(r.draws)
        assert all(0 <= d.shard < 5 for d in r.draws)
        by_source.setdefault(r.source, []).append((r.size * len(r.draws), r.target, r.source_size))
    names = sorted(by_source, key=lambda s: (s is None, s))
    sizes = [by_source[s][0][2] for s in names]
    for name, target in zip(names, targets(sizes, (1, 2, 3), 3)):
        found = sum(x[0] for x in by_source[name])
        assert by_source[name][0][1] == target and abs(found - target) <= 15
    copies = mixing.mixed(documents(*table), block_docs=16, shards=5)
    assert copies.columns == documents(*table).columns
    assert copies.count() == sum(len(r.draws) for r in got)


@pytest.mark.parametrize("of", [targets, targets_by_spark])
def test_targets_reshare_the_excess(llm, of):
    of = of if of is targets else lambda *a: targets_by_spark(llm, *a)
    assert of([100, 100, 100], (1, 2, 3), 3) == [50.0, 100.0, 150.0]
    assert of([300, 10, 20], (1, 2, 3), 3) == [240.0, 30.0, 60.0]
    assert of([0, 0], (1, 2), 3) == [0.0, 0.0]
    assert of([], (1, 2), 3) == []


def test_targets_of_many_sources(llm):
    import random

    draw = random.Random(2)
    for most in (1, 2, 3):
        sizes = [int(10 ** draw.uniform(0, 5)) for _ in range(60)]
        assert targets_by_spark(llm, sizes, (1, 2, 3, 5), most) == targets(sizes, (1, 2, 3, 5), most)


def test_sources_in_groups_are_split_exactly(llm, documents, monkeypatch):
    """More sources than one walk through the tree takes, numbered by code point."""
    monkeypatch.setattr(mixing, "GROUP", 7)
    monkeypatch.setattr(mixing, "CHUNK", 2)
    names = [f"s{i}" for i in range(40)] + ["Z", "é", "\U0001f600", "\uffee", "", None]
    table = [(i, prose(3 + i % 30, i), names[i % len(names)]) for i in range(1400)]
    got = mixing.draws(documents(*table), block_docs=4, shards=6).collect()
    order = sorted(names, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(len(t.split()) for _, t, of in table if of == s) for s in names}
    expected = dict(zip(order, targets([sizes[s] for s in order], (1, 2, 3), 3)))
    taken = dict.fromkeys(names, 0)
    by_shard = [0] * 6
    for r in got:
        assert (r.target, r.source_size) == (expected[r.source], sizes[r.source])
        taken[r.source] += r.size * len(r.draws)
        for d in r.draws:
            by_shard[d.shard] += 1
    assert all(abs(taken[s] - expected[s]) <= 33 for s in names)
    assert max(by_shard) < 1.6 * min(by_shard)


def test_a_document_that_is_most_of_its_source(llm, documents):
    """Rows that repeat fill the target as far as they fit, some once more than others."""
    table = [(1, "one two three", "a")] * 300 + [(2, "w " * 400, "b"), (3, "v " * 10, "b")]
    got = mixing.draws(documents(*table), block_docs=8, shards=3).collect()
    a = [len(r.draws) for r in got if r.source == "a"]
    target = next(r.target for r in got if r.source == "a")
    assert len(a) == 300 and abs(3 * sum(a) - target) < 3 and max(a) - min(a) == 1
    copies = mixing.mixed(documents(*table), block_docs=8, shards=3)
    assert copies.filter("doc_id = 1").count() == sum(a)


def test_mixed_carries_columns_of_any_name(llm, documents):
    extra = "key long, doc long, draws long, fits long, n long, id long, rank long, shard long, draw long"
    rows = [(i, prose(9, i), "en", f"s{i % 2}", 0, *range(i, i + 9)) for i in range(60)]
    docs = llm.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
    got = mixing.mixed(docs, block_docs=8, shards=3).collect()
    assert {tuple(r) for r in got} <= set(rows) and len(got) > 30
    shards = mixing.mixed(docs, block_docs=8, shards=3, shard="of_shard")
    assert shards.columns == [*docs.columns, "of_shard"]
    assert {r.of_shard for r in shards.collect()} == {0, 1, 2}


def test_split_draws_are_disjoint_and_whole():
    counts = np.array([5, 0, 1000, 17])
    at = np.zeros(4, int)
    for shard in range(7):
        first, own = mixing.split_draws(counts, 7, shard, 3)
        assert (first == at).all()
        at = at + own
        assert abs(own.sum() - counts.sum() / 7) <= 7
    assert (at == counts).all()


def test_toxicity_on_held_out_rows(llm, documents):
    table = [(i, prose(30, i) + (" nasty vilest words" if i % 4 == 0 else "")) for i in range(300)]
    table += [(900, None), (901, ""), (901, "")]
    labels = llm.createDataFrame(
        [(i, 1, int(i % 4 == 0)) for i in range(200)] + [(None, 1, 1), (5, None, 0)],
        "doc_id long, quality int, toxic int",
    )
    docs = documents(*table)
    model = toxicity.train(docs, labels, grade=toxicity.label_grade(), grades=3)
    assert model.thresholds[0] < model.thresholds[1]
    got = toxicity.severity(docs, model).collect()
    assert len(got) == len(table)
    assert {r.doc_id for r in got if r.toxic} == set(range(0, 300, 4))
    assert toxicity.without_toxic(docs, model).count() == len(table) - 75
    none = toxicity.train(docs, labels.limit(0), grade=toxicity.label_grade(), grades=3)
    assert not any(r.toxic for r in toxicity.severity(docs, none).collect())


@pytest.mark.parametrize("toxic", [0, 1])
def test_labels_of_one_kind_reject_nothing(llm, documents, toxic):
    docs = documents(*[(i, prose(30, i)) for i in range(40)])
    labels = llm.createDataFrame([(i, 1, toxic) for i in range(20)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels, grade=toxicity.label_grade(), grades=toxicity.GRADES)
    assert toxicity.without_toxic(docs, model).count() == 40
    assert toxicity.severity(docs, model).filter("toxic OR grade > 0 OR severity > 0").count() == 0


def test_licenses_are_inherited_from_the_nearest_directory(llm):
    text = prose(100, 1)
    files = llm.createDataFrame(
        [
            (1, "LICENSE", "Released under the MIT License."),
            (2, "a/x.py", text), (3, "a/b/x.py", text), (4, "a/b/c/d/x.py", text),
            (5, "a/b/COPYING", f"{text}\n\nLicensed under the Apache License, Version 2.0."),
            (6, "a/b/y.py", f"# {text}\n# This work is licensed under the GNU General Public License, version 3."),
            (7, None, text), (8, "z", None), (9, "q/w", ""), (9, "q/w", ""),
        ],
        "id long, path string, text string",
    )
    got = {(r.id, r.license, r.origin, r.license_path) for r in license_scan.scan(files).collect()}
    assert got == {
        (1, "MIT", "own", "LICENSE"), (2, "MIT", "inherited", "LICENSE"),
        (3, "Apache-2.0", "inherited", "a/b/COPYING"), (4, "Apache-2.0", "inherited", "a/b/COPYING"),
        (5, "Apache-2.0", "own", "a/b/COPYING"), (6, "GPL-3.0", "own", "a/b/y.py"),
        (7, None, None, None), (8, "MIT", "inherited", "LICENSE"), (9, "MIT", "inherited", "LICENSE"),
    }


def licence_by_hand(text, templates, texts, frequency, threshold=0.7):
    """(licence, cosine) over every line, paragraph and window, without looking for heavy terms."""
    import math

    known = {t for x in templates for t in license_scan.terms(x.text)}
    weigh = lambda t: math.log((1 + texts) / (1 + frequency.get(t, 0) * (t in known))) + 1

    def vector(found):
        raw = {t: found.count(t) * weigh(t) for t in set(found)}
        length = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / length for t, w in raw.items()}

    every = license_scan.terms(text)
    spans, at = [], 0
    for paragraph in re.split(r"\n[^\S\n]*\n", text):
        begin = at
        for line in paragraph.split("\n"):
            low, at = at, at + len(license_scan.terms(line))
            spans.append((low, at, low, at, False))
        spans.append((begin, at, begin, at, True))
    best = None
    for x in templates:
        needs, bars, later, never = (set(y.split()) for y in x[2:])
        own = vector(license_scan.terms(x.text))
        size = len(license_scan.terms(x.text))
        places = {s[:4] for s in spans}
        for low, high, _, _, whole in spans:
            if whole:
                places |= {(a, a + size, low, high) for a in range(low, high - size + 1)}
        for a, b, low, high in places:
            inside = every[a:b]
            if not needs <= set(inside) or bars & set(every[max(low, a - 4) : min(high, b + 4)]):
                continue
            said = min(i for i in range(a, b) if every[i] in needs)
            if license_scan.NEGATIONS & set(every[max(low, said - 4) : said]):
                continue
            ahead = set(every[a : b + 250])
            if not later <= ahead or never & ahead:
                continue
            other = vector(inside)
            cosine = sum(w * other.get(t, 0) for t, w in own.items())
            if cosine >= threshold:
                key = (x.name != license_scan.NO_LICENCE, round(cosine, 9), a - b, x.name)
                best = key if best is None else max(best, key)
    return (best[3], min(1.0, best[1])) if best else (None, None)


def test_license_scan_against_brute_force(llm):
    """Notices, titles and identifiers, whole, cut, joined and negated, in lines and paragraphs."""
    import random
    from collections import Counter

    draw = random.Random(6)
    notices = [x.text for x in license_scan.TEMPLATES]
    texts = [None, "", "\n\n", notices[0], "all rights reserved " * 300]
    for i in range(260):
        parts = []
        for _ in range(draw.randrange(1, 5)):
            words = draw.choice(notices).split()
            if draw.random() < 0.3:
                words = words[draw.randrange(3) : len(words) - draw.randrange(3)]
            if draw.random() < 0.2:
                words.insert(draw.randrange(len(words) + 1), draw.choice(["not", "NC", "lesser", "endorse", "advertising"]))
            parts += [" ".join(words), prose(draw.randrange(12), i)]
        texts.append("".join(p + draw.choice([" ", "\n", "\n\n", "\n \n"]) for p in parts))
    files = llm.createDataFrame(
        [(i, f"d{i}/f", t, 1.0, "x") for i, t in enumerate(texts)],
        "id long, path string, text string, score double, license string",
    )
    frequency = Counter(t for x in texts for t in set(license_scan.terms(x or "")))
    expected = {
        i: licence_by_hand(x or "", license_scan.TEMPLATES, len(texts), frequency) for i, x in enumerate(texts)
    }
    got = {r.id: (r.license, r.score) for r in license_scan.scan(files.repartition(3)).collect()}
    assert {i: n for i, (n, _) in got.items()} == {i: n for i, (n, _) in expected.items()}
    assert all(s is None or abs(s - expected[i][1]) < 1e-6 for i, (_, s) in got.items())
    assert len({n for n, _ in expected.values()}) > 25


@pytest.mark.parametrize(
    "text,name",
    [
        ("// SPDX-License-Identifier: MIT", "MIT"), ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
        ("# SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"), ("SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"),
        ("SPDX-License-Identifier: CC-BY-SA-4.0", "CC-BY-SA-4.0"), ("SPDX-License-Identifier: MIT-0", "MIT-0"),
        ("   Apache License\n  Version 2.0, January 2004\n http://www.apache.org/licenses/\n\nTERMS", "Apache-2.0"),
        ("Mozilla Public License Version 2.0\n====\n\n1. Definitions", "MPL-2.0"),
        ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nCopyright", "GPL-3.0"),
        ("CC0 1.0 Universal", "CC0-1.0"), ("Released under GPLv3", "GPL-3.0"), ("Licensed under the LGPL v3.", "LGPL-3.0"),
        ("This is free and unencumbered software released into the public domain.\n\nAnyone is free", "Unlicense"),
        ("Eclipse Public License - v 2.0", "EPL-2.0"), ("Boost Software License - Version 1.0 - August 17th, 2003", "BSL-1.0"),
        ("Not released under the MIT License.", None), ("This isn't licensed under the Apache License, Version 2.0.", None),
        ("Released under the MIT License, not the GPL.", "MIT"), ("spdx identifier " * 5000, None),
    ],
)
def test_headers_titles_and_negations(llm, text, name):
    n, frequency = 1000, {t: 3 for x in license_scan.TEMPLATES for t in license_scan.terms(x.text)}
    found = license_scan.Matcher(license_scan.TEMPLATES, n, frequency, 0.7).best(text)
    assert (found and found[0]) == name


def test_neighbouring_licenses_are_told_apart(llm):
    work = "This work is licensed under the GNU"
    bsd = license_scan._BSD + ":\n\n1. Source code must retain the notice.\n2. Binary forms must reproduce the notice."
    cases = [
        (f"{work} General Public License, version 2.", "GPL-2.0"),
        (f"{work} General Public License, version 3.", "GPL-3.0"),
        (f"{work} Affero General Public License, version 3.", "AGPL-3.0"),
        (f"{work} Lesser General Public License, version 2.1.", "LGPL-2.1"),
        (f"{work} General Public License, version 1.", None),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"), ("Licensed under CC BY-NC-SA 3.0.", "CC-BY-NC-SA-3.0"),
        ("Licensed under CC BY-NC 1.0.", None),
        ("This work is licensed under a Creative Commons Attribution-Share Alike 4.0 International License.", None),
        ("Released under the MIT License.", "MIT"), ("Released under the ISC License.", "ISC"),
        ("Released under the Zlib License.", None), ("All rights reserved.", "All-Rights-Reserved"),
        ("Copyright 2020 A. All rights reserved.\nReleased under the MIT License.", "MIT"),
        ("Licensed under the Apache License, Version 1.1.", None),
        (bsd, "BSD-2-Clause"), (bsd + "\n3. No name may be used to endorse products.", "BSD-3-Clause"),
        (license_scan._BSD, None),
        # within long lines and paragraphs, also across line ends
        (f"{prose(30, 1)} {work} General Public License, version 2. {prose(30, 2)}", "GPL-2.0"),
        (f"{prose(30, 1)} {work} Lesser General\nPublic License, version 3. {prose(30, 2)}", "LGPL-3.0"),
        (f"{prose(60, 3)} Licensed under CC BY-NC 4.0. {prose(60, 4)}", "CC-BY-NC-4.0"),
        (prose(60, 5), None),
    ]
    files = llm.createDataFrame([(i, f"d{i}/x", t) for i, (t, _) in enumerate(cases)], "id long, path string, text string")
    got = {r.id: r.license for r in license_scan.scan(files).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(cases)] == cases


@pytest.mark.parametrize(
    "build",
    [
        packing.pack_documents, token_counts.token_counts, ngram_join.joined, suffix_dedup.digest,
        suffix_dedup.without_repeats, mixing.draws, mixing.mixed,
        lambda d: license_scan.scan(d.select(F.col("doc_id").alias("id"), F.col("source").alias("path"), "text")),
    ],
)
def test_empty_tables(documents, build):
    assert build(documents((1, "x")).limit(0)).count() == 0
