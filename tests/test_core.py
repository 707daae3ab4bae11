"""Behaviour that SQL twins don't show: units, guards, sources, supersession, streams and plans."""

import importlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quillstone.functions import text as x
from quillstone.functions import vector
from quillstone.operators import graph, guard, quotes, retrieval, segment, similarity, temporal
from quillstone.plans import registry
from quillstone.sources import readers
from quillstone.streaming import traces

FACT = "id bigint, object_id bigint, dimension string, value string, valid_from date, valid_to date, status string, source_doc_id bigint"


def facts(spark, rows):
    import datetime as dt

    day = lambda s: dt.date.fromisoformat(s) if s else None
    return spark.createDataFrame([(i, o, d, v, day(a), day(b), s, c) for i, o, d, v, a, b, s, c in rows], FACT)


def test_supersession_cases(spark):
    f = facts(spark, [(1, 1, "rank", "a", "2020-01-01", None, "confirmed", 1), (2, 1, "rank", "b", "2021-01-01", None, "confirmed", 2), (3, 1, "rank", "c", "2019-01-01", None, "confirmed", 3), (4, 1, "rank", "d", "2021-01-01", None, "confirmed", 4), (5, 1, "rank", "e", None, None, "confirmed", 5)])
    got = {r.id: (str(r.closed_at) if r.closed_at else None, r.new_status) for r in temporal.supersede(f).collect()}
    assert got == {3: ("2020-01-01", "confirmed"), 1: ("2021-01-01", "confirmed"), 2: (None, "confirmed"), 4: (None, "unconfirmed"), 5: (None, "unconfirmed")}


def test_copies_with_either_apostrophe_are_one(spark):
    f = facts(spark, [(1, 1, "d", "O'Neil", "2020-01-01", None, "confirmed", 9), (2, 1, "d", "O’Neil", "2020-01-01", None, "confirmed", 3), (3, 1, "d", "O’Neil", None, None, "confirmed", 3), (4, 1, "d", "O'Neil", None, None, "confirmed", 2)])
    assert {r.id for r in temporal.distinct_facts(f).collect()} == {2, 4}


@pytest.mark.parametrize("end", ["infinite", "point"])
def test_overlaps_match_all_pairs(spark, end):
    rng = random.Random(2)
    rows = []
    for i in range(200):
        a = f"20{rng.randint(10, 12)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
        b = rng.choice([None, a, f"20{rng.randint(10, 14)}-01-01"])
        rows.append((i, i % 5, "d", "v", rng.choice([a, a, a, None]), b, "confirmed", i))
    stop = lambda r: r[5] or ("9999-12-31" if end == "infinite" else r[4])
    good = [r for r in rows if r[4] and stop(r) >= r[4]]
    want = {(a[0], b[0]) for a in good for b in good if a[0] < b[0] and a[1] == b[1] and a[4] <= stop(b) and b[4] <= stop(a)}
    got = [(r.a_id, r.b_id) for r in temporal.overlaps(facts(spark, rows), end, ["dimension"]).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7), (500, 501)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + k] == 100 for k in range(40)) and got[501] == 500
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


TEXT = "Intro line before anything.\n" + "Contents ........ 3\n" + "Chapter I\nArticle 1\n" + "First article text. " * 10 + "\nArticle 2\n" + "Second one. " * 300 + "\n1. A point with text that goes on. " + "x " * 60 + "\n2. Other\nAnnex 1\n" + "End. " * 30


def test_units_cover_the_text_exactly():
    for text in (TEXT, "no markers at all " * 300, "a", "\n\n\n", "# Head\n" + "body " * 50 + "\n## Sub\n" + "more " * 50):
        units = segment.units_of(text)
        assert units[0]["char_start"] == 0 and units[-1]["char_end"] == len(text)
        for a, b in zip(units, units[1:], strict=False):
            assert b["char_start"] <= a["char_end"]
            assert b["char_start"] == a["char_end"] or a["base_label"] == b["base_label"]
        assert all(u["unit"] == text[u["char_start"] : u["char_end"]] and len(u["unit"]) <= 2000 for u in units)
    labels = [u["base_label"] for u in segment.units_of(TEXT)]
    assert labels[0] == "preamble" and "article 1" in labels and "annex 1" in labels and not any("........" in x for x in labels)


def test_units_of_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, TEXT)], "id bigint, text string")
    assert {r.id for r in segment.units(df, "id").collect()} == {3}


def test_guard(spark):
    spark.createDataFrame([(1, "confirmed")], "id bigint, status string").createOrReplaceTempView("facts")
    allowed = {"facts"}
    assert guard.check(spark, "SELECT count(*) FROM facts WHERE status = 'confirmed'", allowed) is None
    assert "status" in guard.check(spark, "SELECT count(*) FROM facts", allowed)
    assert guard.check(spark, "DROP TABLE facts", allowed) and guard.check(spark, "SELECT * FROM secret", allowed) and guard.check(spark, "SELEC 1", allowed)
    assert guard.check(spark, "INSERT INTO facts VALUES (1, 'confirmed')", allowed)


def test_text_functions(spark):
    row = spark.createDataFrame([("О1 б2 or", "on 31.02.2001", "5.3.21", " It’s — «so» ", "IT'S - \"SO\"")], "a string, b string, c string, d string, e string").select(
        x.fix_digits(F.col("a")).alias("a"), x.date_of(F.col("b")).alias("b"), x.impossible_date(F.col("b")).alias("bad"), x.date_of(F.col("c")).cast("string").alias("c"), x.quoted_verbatim(F.col("d"), F.col("e")).alias("q")
    ).first()
    assert (row.a, row.b, row.bad, row.c, row.q) == ("01 62 or", None, True, "2021-03-05", True)
    names = spark.createDataFrame([("Іваненком",), ("іваненко",), ("Іванов",)], "n string")
    assert names.filter(F.col("n").rlike(x.name_pattern("Іваненко"))).count() == 2
    assert names.filter(F.col("n").rlike(x.name_pattern("Ів"))).count() == 0


def test_cosine_of_zero_is_null(spark):
    r = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0], [2.0, 0.0])], "a array<float>, z array<float>, b array<float>").select(vector.cosine("a", "z").alias("z"), vector.cosine("a", "b").alias("one")).first()
    assert r.z is None and r.one == pytest.approx(1)


def test_only_documents_in_scope_are_searched(spark, sf_dir):
    """A search within a scope is a search of the scope alone: the others change neither ranks nor scores."""
    whole = registry.queries()["a19_normative_search"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id % 4 = 0 and doc_id % 9 <> 0")
    q = spark.read.parquet(f"{sf_dir}/benchmark.parquet").selectExpr("item_id as query_id", "text")
    alone = {(r.query_id, r.doc_id): r.score for r in retrieval.postings(docs, q, "doc_id").bm25(1_000_000).collect()}
    assert whole and all(alone[r.query_id, r.doc_id] == pytest.approx(r.score, abs=2e-4) for r in whole)


def test_queries_in_blocks_give_the_same_rows(spark, sf_dir, monkeypatch):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    q = e.filter("vec_id % 10 = 0").selectExpr("vec_id as query_id", "embedding")
    rows = lambda: sorted(map(tuple, retrieval.nearest(q, e, "vec_id", 3, but_itself=True).collect()))
    want = rows()
    monkeypatch.setattr(retrieval, "BLOCK_QUERIES", 7)
    assert rows() == want and len(want) == 3 * q.count()


def test_quotes_of_any_length_are_found(spark):
    body = "Seven wise  owls watch from an old oak tree, near quiet water."
    texts = [(1, body), (2, body.upper()), (3, "other words stand here"), (4, None), (5, "")]
    asked = ["wise owls watch from", "owls", "Seven wise", "se owls wat", "an old oak tree, near quiet water.", "wise owls watch from an old oak tr", "oak tree", "not there at all", "", None, "seven wise owls watch from an old oak tree, near quiet water. more"]
    t = spark.createDataFrame(texts, "doc_id int, text string")
    q = spark.createDataFrame(list(enumerate(asked)), "query_id int, quote string")
    fold = lambda s: " ".join(s.lower().split())
    want = {(i, d) for i, s in enumerate(asked) if s is not None for d, b in texts if b is not None and fold(s) in fold(b)}
    got = [tuple(r) for r in quotes.holders(q, t, "doc_id", x.fold_quote).select("query_id", "doc_id").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert quotes.holders(q.limit(0), t, "doc_id").count() == 0


def test_closest_names_match_a_plain_comparison(spark):
    import random
    from difflib import SequenceMatcher

    rng = random.Random(4)
    names = [" ".join("".join(rng.choice(["ko", "va", "len", "chuk", "ya", "rem"]) for _ in range(rng.randint(1, 3))).title() for _ in range(2)) for _ in range(60)] + ["", None]
    asked = ["kovalen", "Remchuk", "zzz", "", "valen koya"]
    n = spark.createDataFrame(list(enumerate(names)), "object_id int, name string")
    q = spark.createDataFrame(list(enumerate(asked)), "query_id int, asked string")
    ratio = lambda a, b: SequenceMatcher(None, a, b, autojunk=False).ratio()
    want = set()
    for i, a in enumerate(asked):
        a = a.strip().lower()
        scored = [(max([ratio(a, x.lower())] + [ratio(a, w.lower()) for w in x.split()]), j) for j, x in enumerate(names) if x and a]
        want |= {(i, j, round(s, 6), k + 1) for k, (s, j) in enumerate(sorted((x for x in scored if x[0] >= 0.55), key=lambda x: (-round(x[0], 6), x[1]))[:3])}
    assert {tuple(r) for r in similarity.closest(n, q, 0.55, 3).collect()} == want


def test_duplicate_groups_match_a_plain_comparison(spark, sf_dir):
    """All pairs of heads by the plain ratio: at least 0.9 of the links, and the groups that follow from them."""
    from difflib import SequenceMatcher

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(90).collect()
    base = " ".join(f"word{i * 7919 % 997} goes" for i in range(60))
    extra = [(1000 + k, " ".join(f"{w}x" if i % (6 + k) == 0 else w for i, w in enumerate(base.split()))) for k in range(6)] + [(1010, base), (1011, base + " {a note}"), (1012, None)]
    rows = [(r.doc_id, r.text, None) for r in docs] + [(i, t, {1010: "n1", 1012: "n1"}.get(i)) for i, t in extra]
    head = lambda t: " ".join(re.sub(r"\{[^{}]*\}", " ", t[:3000].lower()).split())
    heads = {i: head(t) for i, t, _ in rows if t is not None}
    ids = sorted(heads)

    def alike(a, b):
        m = SequenceMatcher(None, heads[a], heads[b])
        return heads[a] == heads[b] or (m.quick_ratio() >= 0.6 and m.ratio() >= 0.6)

    want = {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if alike(a, b)}
    df = spark.createDataFrame(rows, "doc_id bigint, text string, identifier string")
    got = {r.document_id: r.canonical_id for r in similarity.duplicate_groups(df).collect()}
    assert len(got) == len(rows)
    together = sum(got[a] == got[b] for a, b in want)
    assert want and together >= 0.9 * len(want)
    root = {i: i for i in got}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in [*want, (1010, 1012)]:
        root[find(a)] = find(b)
    assert all(find(a) == find(b) for a in got for b in got if got[a] == got[b])
    assert got[1012] == got[1010] == 1010  # it has the identifier
    found = {r.doc_id: r.links for r in similarity.similar_heads(df.select("doc_id", "text")).collect()}
    assert sum(found.values()) >= 0.9 * 2 * len({(heads[a], heads[b]) for a, b in want if heads[a] != heads[b]})


def test_counting_pushes_filters_and_prunes_columns(spark, sf_dir):
    plan = registry.queries()["a01_count_by_state_on_date"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" in plan.split("PushedFilters")[1].split("]")[0] and "o_totalprice" not in plan


def test_similar_strings(spark):
    df = spark.createDataFrame([("abcd", "bcde"), ("same", "same"), (None, "x")], "a string, b string")
    assert [r.ratio for r in similarity.ratios(df, "a", "b").orderBy("a").collect()] == [0.0, 0.75, 1.0]


def test_islands(spark):
    parts = spark.createDataFrame([(1, 0, 10), (1, 5, 20), (1, 20, 25), (1, 40, 50)], "k int, char_start int, char_end int")
    assert sorted(r.island for r in retrieval.islands(parts, ["k"]).collect()) == [0, 0, 0, 1]


def test_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in ("a.docx", "b.JPG", "c.exe"):
        (tmp_path / "in" / n).write_bytes(n.encode())
    got = {r.path.rsplit("/", 1)[1]: (r.source_kind, r.error) for r in readers.scan_folder(spark, str(tmp_path / "in")).collect()}
    assert got == {"a.docx": ("electronic", None), "b.JPG": ("photo", None), "c.exe": (None, "unsupported: exe")}
    (tmp_path / "roster.csv").write_text("﻿name,born\n Ann ,2001-02-03\n,2001-2-3\n", encoding="utf-8")
    rows = readers.read_roster(spark, str(tmp_path / "roster.csv"), ["born"]).collect()
    assert [(r.name, str(r.born)) for r in rows] == [("Ann", "2001-02-03"), (None, "None")]
    (tmp_path / "trace.jsonl").write_text('{"id": 1}\n{"id": 2}\n{"id": ')
    assert readers.read_trace(spark, str(tmp_path / "trace.jsonl"), "id bigint").count() == 2


def test_streams(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(3).write.json(str(tmp_path / "in"))
    stream = traces.folder(spark, str(tmp_path / "in"))

    def run(df, mode, name):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return spark.table(name)

    got = run(traces.latency(stream), "complete", "latency").agg(F.sum("n")).first()[0]
    assert got == 2 * events.count()  # each event lies in two sliding windows
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", F.lit("2024-01-01").cast("timestamp").alias("ts"))
    texts.write.json(str(tmp_path / "docs"))
    first = traces.first_copies(spark.readStream.schema("text string, ts timestamp").json(str(tmp_path / "docs")))
    assert run(first, "append", "copies").count() == texts.distinct().count()
    assert run(traces.carried_slots(stream), "append", "slots").count() == events.count()


def test_entry_point():
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(registry.queries()) > 100


def plain_chunks(text, size=1200, overlap=200):
    """Paragraphs put together, by a plain loop."""
    out, held, begin, at = [], "", 0, 0
    for part in re.split(r"(\n\s*\n)", text):
        bare, low = part.strip(), at + len(part) - len(part.lstrip())
        at += len(part)
        if not bare:
            continue
        if len(bare) > size:
            out += [(begin, held)] if held else []
            out += [(low + i, bare[i : i + size]) for i in range(0, len(bare), size - overlap)]
            held = ""
        elif held and len(held) + len(bare) + 1 > size:
            out.append((begin, held))
            lead = held[-overlap:]
            held, begin = lead + "\n" + bare, max(0, low - len(lead) - 1)
        elif held:
            held += "\n" + bare
        else:
            held, begin = bare, low
    return [c for c in [*out, *([(begin, held)] if held else [])] if len(c[1].strip()) >= 80]


def test_paragraph_chunks_match_a_plain_loop(spark):
    rng = random.Random(12)
    texts = [None, "", "short", "\n\n  \n\n", "x" * 5000]
    for _ in range(40):
        texts.append("".join("w" * rng.choice([3, 60, 250, 500, 1100, 1300, 2700]) + rng.choice([" end", "", "\n line"]) + rng.choice(["\n\n", "\n \n\n", "\n\n  "]) for _ in range(rng.randint(1, 9))))
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for r in segment.paragraph_chunks(df, "id").orderBy("id", "ord").collect():
        got.setdefault(r.id, []).append((r.start, r.chunk))
    for i, t in enumerate(texts):
        assert got.get(i, []) == plain_chunks(t or ""), i


def test_rules_tell_points_from_items():
    long_ = " words of a point that is long enough to be a unit of its own, and some more of them, and then the end"
    text = "".join(f"{n}.{long_}\n" for n in (1, 2)) + "".join(f"{n}.{long_} item\n" for n in (1, 2)) + f"\n3.{long_}\nArticle 5\n1.{long_}\n"
    labels = {rule: [m[1] for m in segment.marks_of(text, rule)] for rule in segment.RULES}
    assert labels["union"] == ["point 1", "point 2", "point 1", "point 2", "point 3", "article 5", "point 1"]
    assert labels["blank"] == labels["blank+seq"] == ["point 1", "point 3", "article 5"]
    assert labels["seq"] == ["point 1", "point 2", "point 2", "point 3", "article 5", "point 1"]
    assert labels["nest"] == ["point 1", "point 2", "point 2 / point 1", "point 2 / point 2", "point 2 / point 3", "article 5", "point 1"]
    for rule in segment.RULES:
        units = segment.units_of(text, rule=rule)
        assert units[0]["char_start"] == 0 and units[-1]["char_end"] == len(text)
        assert all(a["char_end"] >= b["char_start"] for a, b in zip(units, units[1:], strict=False))
    with pytest.raises(ValueError):
        segment.marks_of(text, "other")


def test_limits_and_deadlines(spark):
    import time

    spark.range(1000).createOrReplaceTempView("numbers")
    assert guard.ask(spark, "select id from numbers limit 900", {"numbers"}).count() == 200
    assert guard.ask(spark, "select id from (select id from numbers limit 3)", {"numbers"}, 200).count() == 3
    assert guard.limited(spark.sql("select id from numbers limit 5")).count() == 5
    with pytest.raises(PermissionError):
        guard.ask(spark, "drop view numbers", {"numbers"})
    assert guard.within(spark, 60, lambda: spark.range(10).count()) == 10
    slow = F.udf(lambda i: time.sleep(30) or i, "long")
    began = time.time()
    with pytest.raises(TimeoutError):
        guard.within(spark, 2, lambda: spark.range(4).select(slow("id")).collect())
    assert time.time() - began < 25 and spark.range(3).count() == 3


def test_catalogs(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("templates:\n - {id: a, title: Über}\n - {id: b, more: 1}\nwords:\n  home: household\n  machines: machinery\n", encoding="utf-8")
    rows = readers.read_catalog(spark, str(tmp_path / "c.yaml"), "templates", "id string, title string").collect()
    assert [tuple(r) for r in rows] == [("a", "Über"), ("b", None)]
    assert readers.read_catalog(spark, str(tmp_path / "c.yaml"), "words", "alias string, code string").count() == 2
    assert readers.read_catalog(spark, str(tmp_path / "c.yaml"), "none", "id string").count() == 0


def test_made_up_papers_are_read_back(spark):
    """What a roster's papers say is what the form functions read from them."""
    from quillstone.functions import forms
    from quillstone.plans.forms import TEMPLATES
    from quillstone.sources import generators

    people = generators.roster(spark)
    rows = people.collect()
    assert len(people.columns) == 37 and len({r.service_id for r in rows}) == 300
    assert [sum(r.subdivision == u for r in rows) for u in generators.UNITS] == [15, 90, 90, 90, 15]
    assert all(r.birth_date < r.service_entry_date < r.enrollment_date <= r.position_assigned_date for r in rows)
    assert rows == generators.roster(spark).collect() and rows != generators.roster(spark, seed=7).collect()
    made = generators.papers(people)
    when = F.regexp_extract("text", r"з (\d+) (\p{L}+) (\d{4})", 0)
    read = made.select(
        "*",
        forms.identified_template(F.col("text"), TEMPLATES)["template"].alias("template"),
        forms.rank_and_name(F.element_at(F.split("text", "\n"), 2)).alias("who"),
        forms.date_of_parts(*(F.regexp_extract(when, r"(\d+) (\p{L}+) (\d{4})", i) for i in (1, 2, 3))).alias("day"),
        forms.attested_numbers(F.col("text")).alias("numbers"),
    ).collect()
    for r in read:
        assert (r.template, r.who["rank"], r.who["surname"], r.day) == (r.kind, r["rank"], r.last_name.upper(), r.start), r.text
        assert {r.number, r.days} <= set(r.numbers)


def test_embedding_stand_in_is_of_length_one(spark, sf_dir):
    rows = registry.queries()["s14_embed_missing"](spark, sf_dir).collect()
    again = {r.doc_id: r.embedding for r in registry.queries()["s14_embed_missing"](spark, sf_dir).collect()}
    have = {r.vec_id for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id").collect()}
    assert not have & {r.doc_id for r in rows}
    for r in rows:
        assert len(r.embedding) == 64 and r.embedding == again[r.doc_id]
        assert sum(x * x for x in r.embedding) == pytest.approx(1, abs=1e-3)


def test_page_store(spark, tmp_path):
    from quillstone.sources.pages import PageStore

    store = PageStore(spark, str(tmp_path / "pages"))
    assert store.index().count() == 0 and store.index(retired=True).count() == 0
    store.write("leave", {"title": "Відпустка", "kind": "form"}, "First\n---\nbody")
    store.write("travel", {"title": "T"}, "")
    store.write("leave", {"title": "Відпустка 2"}, "Second")
    pages = {r.name: r for r in store.index().collect()}
    assert set(pages) == {"leave", "travel"} and pages["leave"].body == "Second" and "Відпустка 2" in pages["leave"].head
    found = store.known(spark.createDataFrame([(pages["leave"].checksum,), ("0",)], "checksum string")).collect()
    assert [r.name for r in found] == ["leave"]
    store.retire("leave")
    store.write("leave", {"title": "3"}, "Third\n---\nend")
    store.retire("leave")
    assert {r.name for r in store.index().collect()} == {"travel"}
    assert {r.name: r.body for r in store.index(retired=True).collect()} == {"leave.1": "Second", "leave.2": "Third\n---\nend"}
    with pytest.raises(FileNotFoundError):
        store.retire("leave")
    assert not list((tmp_path / "pages").glob("*.part"))


def test_evaluation_sets(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("# comment\nq1\t7\ta \"quoted\" part\nq2\t8\t\n", encoding="utf-8")
    rows = readers.read_tsv(spark, str(tmp_path / "t.tsv"), ["question", "doc", "part"]).collect()
    assert [tuple(r) for r in rows] == [("q1", "7", 'a "quoted" part'), ("q2", "8", None)]
