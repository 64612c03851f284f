"""The stages one after another on a small table."""

import corpus_pipeline
from mercato.llm import suffix_dedup
from tests.llm.conftest import prose


def test_stages(llm, documents, tmp_path):
    copies = [(i, prose(120, 1) + f" tail{i}", f"s{i % 3}") for i in range(5)]
    table = [(100 + i, prose(40, 50 + i) + (" vile rotten talk" if i % 5 == 0 else ""), f"s{i % 3}") for i in range(100)]
    table += [*copies, (300, None, "s1"), (301, "", "s2"), (400, prose(70, 9), None)]
    passage = prose(90, 77)
    table += [(500 + i, f"{prose(60, 600 + i)} {passage}", "s0") for i in range(4)]
    docs = documents(*table)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    llm.createDataFrame(
        [(100 + i, 1, int(i % 5 == 0)) for i in range(100)], "doc_id long, quality int, toxic int"
    ).write.parquet(str(tmp_path / "labels.parquet"))
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = llm.read.parquet(str(tmp_path / name))
        rows[name] = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == documents(*table).columns
    ids = {name: {r.doc_id for r in found} for name, found in rows.items()}
    toxic = {100 + i for i in range(0, 100, 5)}
    assert ids["toxicity"] == {r[0] for r in table} - toxic
    assert ids["ngram_jaccard_join"] == ids["toxicity"] - {1, 2, 3, 4}
    assert ids["suffix_array_dedup"] == ids["ngram_jaccard_join"]
    assert not any(passage in (r.text or "") for r in rows["suffix_array_dedup"])
    assert {r.doc_id for r in rows["best_fit_packing"]} <= ids["suffix_array_dedup"]


# Every name that a stage or what it calls gives to a column of its own.
OWN_NAMES = (
    "all_units anchor at base before bin block bucket bytes cap chunk cls component_id copies copy count cut "
    "doc draw draws earlier entry epoch epochs fits first grp hash high id ids in_words key kept label length low "
    "low_id marks more n n_shingles number of of_key offset other owner part piece rank rest row room score "
    "sequence_id severity sha256 shard shingles size source_size spans start target token tokens total weight "
    "whole words _cls _doc_cls _id _n _spans _words _key _same _draw _row_key _row_same"
).split()


def test_stages_carry_columns_of_any_name(llm, tmp_path):
    """Their values stay with their rows; texts that repeat, are null, empty or very long as well."""
    texts = [(i, prose(60, i), "a") for i in range(30)]
    texts += [(40, prose(80, 40), "b"), (40, prose(80, 40), "b"), (41, prose(80, 40) + " x", "b")]
    texts += [(50, None, "a"), (51, "", None), (None, prose(50, 51), "c"), (60, prose(30_000, 60), "c")]
    texts += [(70 + i, prose(50, 70 + i) + " " + prose(55, 99), "d") for i in range(3)]
    rows = [
        (*text[:2], "en", text[2], 0, *[f"{n}/{text[0]}" for n in OWN_NAMES]) for text in texts
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    docs = llm.createDataFrame(rows, schema + ", ".join(f"`{n}` string" for n in OWN_NAMES))
    llm.createDataFrame([(i, 1, i % 2) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(llm, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = llm.read.parquet(str(tmp_path / name))
        got = docs.collect()
        assert got, name
        assert all(r[n] == f"{n}/{r.doc_id}" for r in got for n in OWN_NAMES), name
        if name == "ngram_jaccard_join":
            ids = [r.doc_id for r in got]
            assert ids.count(40) == 1 and 41 not in ids and {50, 51, 60, None} <= set(ids)
    packed = corpus_pipeline.pack_sequences(llm, docs, str(tmp_path))
    places = [(r.doc_id, r.copy, r.piece, r.start) for r in packed.collect()]
    assert len(set(places)) == len(places) and {p[1] for p in places} and len({p[1] for p in places}) == len(got)


def test_a_sequence_can_be_built(llm, documents):
    """Ids of the last stage laid out by sequence and offset leave no gap and give back the texts."""
    from tokenizers import Tokenizer

    from mercato.llm.shared import tokenizer_path

    encode = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")).encode
    table = [(i, prose(20 + i, i)) for i in range(40)] + [(5, prose(25, 5))] * 2 + [(90, prose(9000, 9))]
    rows = corpus_pipeline.pack_sequences(llm, documents(*table), "").collect()
    sequences, copies = {}, {}
    for r in rows:
        ids = [int.from_bytes(r.ids[i : i + 4], "little") for i in range(0, len(r.ids), 4)]
        assert len(ids) == r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, ids))
        copies.setdefault((r.doc_id, r.copy), []).append((r.start, ids))
    for parts in sequences.values():
        parts.sort()
        assert [at for at, _ in parts] == [sum(len(x) for _, x in parts[:k]) for k in range(len(parts))]
        assert sum(len(x) for _, x in parts) <= 4096
    built = sorted((doc_id, sum((x for _, x in sorted(p)), [])) for (doc_id, _), p in copies.items())
    assert built == sorted((i, [*encode(t, add_special_tokens=False).ids, 1]) for i, t in table)


def test_empty_tables_go_through_all_stages(llm, documents, tmp_path):
    llm.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = documents((1, "a")).filter("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(llm, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = llm.read.schema(docs.schema).parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_passages_of_51_words_leave_the_texts(llm, documents):
    """Also where they have fewer than 400 bytes, and whatever white space is in them."""
    words = [f"w{i}" for i in range(51)]
    passage, shorter = " ".join(words), " ".join(f"v{i}" for i in range(50))
    assert len(passage) < 400
    long_words = "".join(f"{i:04d}" for i in range(100))  # 400 bytes, one word
    table = [(i, f"{prose(30, i)} {passage} {prose(20, 20 + i)}") for i in (1, 2)]
    table += [(3, prose(30, 3) + " " + "\n".join(words)), (4, passage)]
    table += [(i, f"{prose(30, i)} {shorter} {prose(20, 20 + i)}") for i in (5, 6)]
    table += [(i, f"{prose(30, i)} {i}{long_words}{i}") for i in (7, 8)]
    got = {r.doc_id: r for r in corpus_pipeline.drop_repeats(llm, documents(*table), "").collect()}
    for i in (1, 2):
        assert got[i].text == f"{prose(30, i)}  {prose(20, 20 + i)}"
        assert got[i].n_chars == len(got[i].text)
    assert (got[3].text, got[4].text) == (prose(30, 3) + " ", "")
    for i in (5, 6):
        assert got[i].text == dict(table)[i]
    for i in (7, 8):
        assert got[i].text == f"{prose(30, i)} {i}{i}"
    assert suffix_dedup.digest(documents(*table)).filter("doc_id IN (1, 2, 4) AND n_removed > 0").count() == 0


def test_word_spans_against_brute_force(llm, documents):
    texts = {i: prose(60 + 5 * i, 1 + i % 4) + (" \t" if i % 2 else "\n") + prose(30 * i, 9) for i in range(12)}
    texts |= {20: "", 21: " ", 22: prose(500, 5), 23: "é " * 300}
    _, spans = suffix_dedup.repeated_spans(documents(*texts.items()), length=20, words=True)
    found = {r.cls: {n for s in r.spans for n in range(s.low, s.high)} for r in spans.collect()}
    places = {}
    for i, text in texts.items():
        words = text.split()
        for at in range(len(words) - 19):
            places.setdefault(tuple(words[at : at + 20]), []).append((i, at))
    wanted = {}
    for where in places.values():
        if len(where) > 1:
            for i, at in where:
                wanted.setdefault(suffix_dedup.content_class(texts[i].encode()), set()).update(range(at, at + 20))
    assert found == wanted


def test_run_leaves_only_what_the_stages_wrote(llm):
    from pathlib import Path

    from mercato.llm.shared import checkpoint_dir

    folder = Path(checkpoint_dir(llm).removeprefix("file://")) / "llm" / llm.sparkContext.applicationId
    before = {*folder.glob("*")}
    assert corpus_pipeline.run(llm, "/root/testdata/sf0.001").count() > 0
    assert {*folder.glob("*")} == before


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_run_one_python_function(llm, documents, tmp_path):
    """A second one has a worker of its own, which counts against the executor from then on."""
    docs = documents((1, prose(60, 1)), (2, prose(60, 1)), (3, prose(60, 2)), (4, " \n"), (5, None))
    kept = corpus_pipeline.drop_near_copies(llm, docs, str(tmp_path))
    assert plan_of(kept).count("ArrowEvalPython") == 1
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5]


def test_the_plan_of_sequences_needs_no_python(llm, documents, tmp_path):
    docs = documents((1, prose(60, 1)), (2, prose(3000, 2)))
    docs.write.parquet(f"{tmp_path}/docs")
    packed = corpus_pipeline.pack_sequences(llm, llm.read.parquet(f"{tmp_path}/docs"), str(tmp_path))
    assert "ExistingRDD" not in plan_of(packed)
    assert packed.agg({"length": "max"}).first()[0] <= 4096
