"""Relational operators against plain versions on small tables."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import chunking, prompts
from corpusloom.operators import dedup, generate, layout, lexicon, merge, pack, quality, relations
from corpusloom.plans import pipeline
from corpusloom.plans.queries import QUERIES
from corpusloom.sources import dictionary, jsonl, pdf, tables

DATA = "/root/testdata/sf0.001"
TERMS = [
    (0, "ガス軸受", "空気で回転軸を支持する技術", "詳細。", ["ガスベアリング"], "機械工学", 1.0),
    (1, "軸受", "軸を支える部品", "", [], "", 0.8),
    (2, "回転軸", "まわる棒", "", [], "", 0.9),
]
TERM_SCHEMA = "pos int, headword string, brief_definition string, definition string, synonyms array<string>, domain string, confidence double"


@pytest.fixture
def terms(spark):
    return spark.createDataFrame(TERMS, TERM_SCHEMA)


def test_folds(spark, terms):
    df = spark.createDataFrame([(1, "ガスベアリングとガス軸受と軸受。", "x"), (2, None, "y"), (3, "", "z")], "id int, text string, log string")
    got = {r["id"]: r for r in lexicon.elaborate(df, terms).collect()}
    assert got[1]["text"] == "ガスベアリング（空気で回転軸（まわる棒）を支持する技術）とガス軸受（軸を支える部品）と軸受。"
    assert [x["term"] for x in got[1]["elaborations"]] == ["ガスベアリング", "回転軸", "軸受"] and got[2]["text"] is None and got[3]["elaborations"] == [] and got[1]["log"] == "x"
    got = {r["id"]: r for r in lexicon.generalize(df, terms).collect()}
    assert got[1]["text"] == "空気でまわる棒を支持する技術と空気で回転軸を支持する技術と軸を支える部品。"
    assert [x["original"] for x in got[1]["replacements"]] == ["ガスベアリング", "ガス軸受", "回転軸", "軸受"]
    assert lexicon.generalize(df, terms, changed_only=True).count() == 1


def plain_fold(text, entries, replace):
    used = set()
    for term, head, brief in entries:
        if term in text and brief and (replace or head not in used):
            said = brief.split("。")[0]
            text = text.replace(term, (said[:50] + "..." if len(said) > 50 else said) if replace else f"{term}（{brief}）", 1)
            used.add(head)
    return text


def test_folds_against_plain(spark):
    rng = random.Random(8)
    word = lambda a, b: "".join(rng.choice("あいう") for _ in range(rng.randint(a, b)))
    rows = [(i, word(1, 4), rng.choice(["", word(1, 6), word(1, 3) + "。" + word(1, 3), word(55, 60)]), "d", [word(1, 3)], "", 1.0) for i in range(25)]
    t = spark.createDataFrame(rows, TERM_SCHEMA)
    known = {}
    for _, h, b, _, s, _, _ in rows:
        known[h] = (h, b)
        known[s[0]] = (h, b)
    entries = [(k, *known[k]) for k in sorted(known, key=len, reverse=True)]
    texts = [(i, word(0, 30)) for i in range(200)]
    df = spark.createDataFrame(texts, "id int, text string")
    assert {r["id"]: r["text"] for r in lexicon.elaborate(df, t).collect()} == {i: plain_fold(x, entries, False) for i, x in texts}
    assert {r["id"]: r["text"] for r in lexicon.generalize(df, t).collect()} == {i: plain_fold(x, entries, True) for i, x in texts}


def test_folds_in_slices(spark, terms, monkeypatch):
    df = spark.createDataFrame([(1, "ガスベアリングとガス軸受と軸受。")], "id int, text string")
    whole = [lexicon.elaborate(df, terms).first(), lexicon.generalize(df, terms).first(), sorted(map(tuple, lexicon.find_terms(df, terms, "id").select("rank", "surface").collect()))]
    monkeypatch.setattr(lexicon, "SLICE", 2)
    assert whole == [lexicon.elaborate(df, terms).first(), lexicon.generalize(df, terms).first(), sorted(map(tuple, lexicon.find_terms(df, terms, "id").select("rank", "surface").collect()))]


def test_dictionary_texts(spark):
    rows = [*TERMS, (3, "空", "", "", [], None, None), (4, "軸受", "二度目", "重複", None, None, None), (5, None, "x", "y", None, None, None)]
    t = spark.createDataFrame(rows, TERM_SCHEMA)
    got = {r["pos"]: r["text"] for r in lexicon.definition_texts(t, "definition").collect()}
    assert got == {0: "ガス軸受とは、空気で回転軸を支持する技術。詳細。", 1: "軸受とは、軸を支える部品", 2: "回転軸とは、まわる棒"}
    assert {r["pos"]: r["text"] for r in lexicon.definition_texts(t, "other").collect()}[1] == "軸受: 軸を支える部品"
    assert [(r["pos"], r["n"]) for r in lexicon.pattern_texts(t).orderBy("pos", "n").collect()] == [(0, i) for i in range(6)] + [(4, i) for i in range(5)]
    s = {r["surface"]: (r["ord"]["pos"], r["entry"]["pos"]) for r in lexicon.surfaces(t).collect()}
    assert s["軸受"] == (1, 4) and len(s) == 5
    k = lexicon.extract_keywords(spark.createDataFrame([(1, "軸受と回転軸"), (2, None), (3, "-")], "id int, text string"), t, "id").withColumn("md", lexicon.render_keywords(F.col("keywords"))).collect()
    assert len(k) == 1 and [x["term"] for x in k[0]["keywords"]] == ["軸受", "回転軸"] and k[0]["md"].startswith("## 専門用語解説\n\n### 軸受\n\n- **概要**: 二度目\n")
    empty = spark.createDataFrame([], TERM_SCHEMA)
    assert lexicon.definition_texts(empty).count() == 0 and lexicon.elaborate(spark.createDataFrame([(1, "a")], "id int, text string"), empty).first()["text"] == "a"


def test_graph(spark):
    rows = [(0, "APPLIES_TO", "ガス軸受", "電動ターボ機械", 0), (1, "IS_A", "ガス軸受", "軸受", 0), (2, "APPLIES_TO", "ガス軸受", "電動ターボ機械", 1), (3, "MENTIONS", "ガス軸受", "X", 0), (4, "IS_A", "a" * 64, "軸受", 0), (5, "APPLIES_TO", "ガス軸受", "輸送機器", 0), (6, None, None, None, None)]
    e = spark.createDataFrame(rows, "pos int, type string, source string, target string, key int")
    n = relations.node_relations(e).withColumn("text", relations.format_relations(F.col("relations"))).collect()
    assert len(n) == 1 and n[0]["text"] == "- APPLIES_TO: 電動ターボ機械, 輸送機器\n- IS_A: 軸受" and n[0]["relation_count"] == 3
    assert generate.relation_texts(e).count() == 1 and generate.relation_texts(e, lambda p, s: " ").count() == 0
    assert relations.node_relations(e.limit(0)).count() == 0


def test_safety(column):
    cases = {"TEL 03-1234-5678": False, "電話03-1234-5678": True, "x@y.jp": False, "連絡x@y.jp": True, "123456789012": False, "番号123456789012": True, "1234 5678 9012 3456": False, "": True}
    assert column(quality.is_safe(F.col("text")), [*cases, None]) == [*cases.values(), True]


def plain_near(rows, above):
    kept, out = [], {}
    for i, text in sorted(rows):
        w = set((text or "").split())
        out[i] = not w or any(len(w & k) / len(w | k) > above for k in kept)
        if not out[i]:
            kept.append(w)
    return out


def test_near_duplicates(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for i in range(150):
        if rows and rng.random() < 0.6:
            base = (rng.choice(rows)[1] or "a").split()
            for _ in range(rng.randint(0, 2)):
                base[rng.randrange(len(base))] = rng.choice(words)
            rows.append((i, " ".join(base)))
        else:
            rows.append((i, " ".join(rng.sample(words, rng.randint(1, 20))) if rng.random() < 0.9 else rng.choice([None, "", "  "])))
    df = spark.createDataFrame(rows, "id int, text string")
    for above in (0.85, 0.6):
        got = {r["id"]: r["duplicate"] for r in dedup.near_duplicates(df, "id", above=above).collect()}
        assert got == plain_near(rows, above)
    assert dedup.near_duplicates(df.limit(0), "id").count() == 0
    firsts = dedup.first_of_equal(spark.createDataFrame([(2, "a"), (1, "a"), (3, None), (4, None)], "id int, text string"), F.col("text"), "id")
    assert sorted(r["id"] for r in firsts.collect()) == [1, 3]


def plain_pack(tokens, limit, sep=3):
    numbers, carry, n = [], None, 0
    for t in tokens:
        if t <= limit and carry is not None and carry + sep + t <= limit:
            carry += sep + t
        else:
            n += 1
            carry = t if t <= limit else None
        numbers.append(n)
    return numbers


def test_packing(spark):
    rng = random.Random(5)
    rows = [("big", i, rng.randint(0, 60)) for i in range(900)] + [(f"f{k}", i, rng.randint(0, 60)) for k in range(20) for i in range(rng.randint(0, 9))] + [(None, i, 9) for i in range(5)]
    df = spark.createDataFrame(rows, "f string, pos int, t int")
    got = {}
    for r in pack.pack_numbers(df, "f", "pos", "t", 50).collect():
        got.setdefault(r["f"], {})[r["pos"]] = r["pack"]
    want = {}
    for f, p, t in rows:
        want.setdefault(f, []).append((p, t))
    for f, own in want.items():
        own.sort()
        assert [got[f][p] for p, _ in own] == plain_pack([t for _, t in own], 50)


def test_pack_texts(spark):
    rows = [("f", i, x) for i, x in enumerate(["aaaa", "bbbb", "c" * 10, None, "", "dd", "e" * 11, "f"])]
    df = spark.createDataFrame(rows, "f string, pos int, text string")
    packs = pack.pack(df, "f", "pos", limit=15)
    assert [r["text"] for r in packs.orderBy("pack").collect()] == ["aaaa\n\nbbbb", "c" * 10, "dd", "e" * 11, "f"]
    assert tuple(pack.pack_stats(df, packs).first())[:2] == (6, 5)
    none = pack.pack(df.limit(0), "f", "pos")
    assert none.count() == 0 and pack.pack_stats(df.limit(0), none).first()["ratio"] is None


def test_frequent_edges(spark):
    rows = [("a", i, f"HEAD\nbody {i}\nFOOT" if i < 3 else "HEAD \nother\nlast") for i in range(5)] + [("b", 0, "HEAD\nx\nFOOT"), ("c", 1, None)]
    got = {(r["d"], r["p"]): r["text"] for r in layout.drop_frequent_edges(spark.createDataFrame(rows, "d string, p int, text string"), "d", "p").collect()}
    assert got["a", 0] == "body 0" and got["a", 4] == "other\nlast" and got["b", 0] == "HEAD\nx\nFOOT" and got["c", 1] == ""


def test_grid(spark):
    cells = [(0, 0, "A", 1, 2), (1, 0, "b", None, None), (1, 1, "c\nd", 1, 1), (None, 0, "x", 1, 1)]
    df = spark.createDataFrame([(2, 2, cells), (None, 2, cells)], "r int, c int, cells array<struct<row_index:int,column_index:int,content:string,row_span:int,column_span:int>>")
    g = [r["g"] for r in df.select(layout.grid(F.col("r"), F.col("c"), F.col("cells")).alias("g")).collect()]
    assert g == [[["A", "A"], ["b", "c\nd"]], []]
    md = [r["m"] for r in df.select(layout.grid_markdown(layout.grid(F.col("r"), F.col("c"), F.col("cells"))).alias("m")).collect()]
    assert md == ["| A | A |\n| --- | --- |\n| b | c d |", ""]


def test_merge_and_views(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "日本", "s")], "id int, text string, source string")
    b = spark.createDataFrame([("t",)], "text string")
    u = merge.default_source(merge.union_in_order([a, b]))
    assert sorted((r["step_rank"], r["source"]) for r in u.collect()) == [(0, "extract"), (0, "s"), (1, "extract")]
    assert tuple(merge.merge_stats(u).first()) == (3, 4, 2) and tuple(merge.merge_stats(u.limit(0)).first()) == (0, 0, 0)
    assert merge.parse_steps("graph, dictionary") == ["dictionary", "graph"] and merge.parse_steps("ALL") == merge.STEPS
    with pytest.raises(ValueError):
        merge.parse_steps("nope")
    assert merge.search(a, "日").count() == 1 and merge.record(a, "id", 2).first()["id"] == 2
    n = spark.range(1001).withColumnRenamed("id", "k")
    parts = {r["split"]: r["count"] for r in merge.train_eval(n, "k").groupBy("split").count().collect()}
    assert parts == {"eval": 101, "train": 900} and merge.train_eval(n.limit(0), "k").count() == 0


def test_chat_and_prompts(spark):
    df = spark.createDataFrame([("I", "C", "O"), ("I", " ", "O"), ("I", None, "O")], "i string, c string, o string")
    got = [r["t"] for r in df.select(merge.chat_text(F.col("i"), F.col("c"), F.col("o")).alias("t")).collect()]
    assert "I\n\n背景情報:\nC<|eot_id|>" in got[0] and "<|end_header_id|>\n\nI<|eot_id|>" in got[1] and got[1] == got[2]
    with pytest.raises(ValueError):
        prompts.render("summary", text="x")
    d = spark.createDataFrame([("a{b}$1",)], "text string")
    assert d.select(prompts.render("summary", text=F.col("text"), max_length="9")).first()[0].endswith("a{b}$1")
    assert d.select(prompts.render("none")).first()[0] == ""


def test_generators(spark):
    df = spark.createDataFrame([(1, "x", [("h", "b")]), (2, None, [])], "id int, text string, terms array<struct<headword:string,brief_definition:string>>")
    answer = json.dumps({"qa_pairs": [{"question": "q1", "answer": "a1"}, {"question": "q2", "answer": "a2"}]})
    assert [r["text"] for r in generate.difficult_questions(df, lambda p, s: answer).orderBy("text").collect()] == ["質問: q1\n\n回答: a1", "質問: q2\n\n回答: a2"]
    assert generate.question_answers(df, lambda p, s: '```json\n{"question": "q", "answer": "a"}\n```').first()["text"] == "質問: q\n回答: a"

    def fails(p, s):
        raise RuntimeError

    assert [r["text"] for r in generate.to_english(df, fails).orderBy("id").collect()] == ["x", None] and generate.rewrite(df, "paraphrase", fails).count() == 0
    t = spark.createDataFrame([("a<TABLE>1</table>b",), (None,)], "text string")
    assert [r["text"] for r in generate.describe_tables(t, lambda p, s: "T").collect()] == ["a\n\nT\n\nb", None]

    def fails(p, s):
        raise RuntimeError("down")

    assert generate.describe_tables(t, fails).collect() == t.collect() and generate.describe_tables(t, lambda p, s: None).collect() == t.collect()


def test_perplexity_fails_open(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, " ")], "id int, text string")

    def broken(x):
        raise RuntimeError

    assert quality.filter_perplexity(df, broken).count() == 3
    assert sorted(r["id"] for r in quality.filter_perplexity(df, lambda xs: [1e9] * len(xs)).collect()) == [2, 3]


def test_chunking(spark):
    md = "intro\n\n# A\n" + "あ。" * 500 + "\n\n## B\n" + "い " * 600 + "\n# C\n<!-- Page 7 -->\nshort"
    df = spark.createDataFrame([("x.pdf", md), ("y.pdf", None), ("z.pdf", " ")], "source_file string, text string")
    rows = chunking.chunk_documents(df).collect()
    assert sorted(r["source_file"] for r in rows if r["error"]) == ["y.pdf", "z.pdf"]
    own = [r for r in rows if r["source_file"] == "x.pdf"]
    assert all(len(r["text"]) <= 1500 for r in own) and own[0]["id"] == "x_c1"
    assert {r["meta"]["section_path"] for r in own} >= {"", "A", "C"} and own[-1]["meta"]["page_start"] == 7
    assert chunking.split_size("a" * 25, 10, 2) == ["a" * 10, "a" * 10, "a" * 9]
    assert chunking.split_size("aa bb cc dd", 5, 2) == ["aa bb", "cc", "dd"]
    assert chunking.split_headings("# A\n```\n# no\n```\nx", "#") == [("# A  \n```  \n# no  \n```  \nx", "A")]


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "a.jsonl")
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"text":"ok","k":1}\n{bad\n\n{"id":"no_text"}\n{"text":null}\n5\n')
    assert [r["text"] for r in jsonl.lenient(spark, path).collect()] == ["ok"]
    assert jsonl.merged(spark, [path]).count() == 4 and jsonl.lenient(spark, path, max_lines=0).count() == 0
    with pytest.raises(Exception):
        jsonl.strict(spark, path).collect()
    out = str(tmp_path / "out")
    jsonl.write(spark.createDataFrame([(2, "b", None), (1, "a", "s")], "pos int, text string, source string"), out, order="pos")
    assert [r["text"] for r in spark.read.json(out).orderBy("pos").collect()] == ["a", "b"]
    d = tmp_path / "d.json"
    d.write_text(json.dumps({"terms": [{"headword": "h"}]}))
    assert dictionary.read_terms(spark, str(d)).first()["confidence"] == 1.0
    g = tmp_path / "g.json"
    g.write_text(json.dumps({"graph": {"edges": [{"type": "IS_A", "source": "a", "target": "b", "key": 0}]}}))
    assert relations.distinct_edges(dictionary.read_edges(spark, str(g))).count() == 1


def test_pdfs(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF stream\n(one) Tj (two) Tj\nendstream stream\n(p2) Tj endstream")
    (tmp_path / "b.pdf").write_bytes(b"nothing")
    rows = {r["source_file"]: r for r in pdf.read_pdfs(spark, str(tmp_path)).collect()}
    assert rows["a.pdf"]["text"] == "<!-- Page 1 -->\none\ntwo\n\n<!-- Page 2 -->\np2" and rows["b.pdf"]["error"] == "no text"
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        pdf.read_pdfs(spark, str(tmp_path / "none"))


def test_blank_texts_are_not_asked_about(spark):
    df = spark.createDataFrame([(1, "本文", "own"), (2, "", "own"), (3, " \u3000\n", "own"), (4, None, "own")], "id int, text string, question string")
    asked = [generate.rewrite(df, "paraphrase"), generate.rewrite(df, "summary", max_length="150"), generate.question_answers(df, generate.measured_json), generate.focused_questions(df, "people", generate.measured_json), generate.keyword_texts(df, generate.measured_json)]
    for out in asked:
        assert [r["id"] for r in out.collect()] == [1]
        assert out.limit(0).count() == 0 and len(set(out.columns)) == len(out.columns)
    assert generate.keyword_texts(df, lambda p, s: "no json").count() == 0 and generate.question_answers(df, lambda p, s: '{"question": "", "answer": "a"}').count() == 0


def test_figures_tables_and_layout(spark, tmp_path):
    from corpusloom.operators import images

    df = spark.createDataFrame([(1, "a<figure x>1</figure>b<figure>2</figure>c", [("甲", b"12"), (None, b"")]), (2, "x", None), (3, None, [])], "id int, text string, figures array<struct<caption:string,image:binary>>")

    def describe(prompt, image):
        assert "キャプション: " in prompt
        return f"{len(image)} bytes" if image else 1 / 0

    out = images.describe_figures(df, describe)
    got = {r["id"]: r["text"] for r in out.collect()}
    assert got[1] == "a\n\n【図】甲\n2 bytes\n\nb\n\n【図】\n（図の分析に失敗しました）\n\nc" and got[2] == "x" and got[3] is None
    for name, content in (("a.pdf", b"ok"), ("b.pdf", b"bad")):
        (tmp_path / name).write_bytes(content)

    def parser(content):
        if content == b"bad":
            raise ValueError("broken")
        return ["本 文", " "], [(2, 2, [(0, 0, "h", None, 2), (1, 0, "x", 1, 1), (1, 1, None, None, None), (5, 5, "out", 1, 1)])]

    rows = {r["source_file"]: r for r in pdf.read_layout(spark, str(tmp_path), parser).collect()}
    assert rows["a.pdf"]["text"] == "本文\n\n\n\n| h | h |\n| --- | --- |\n| x |  |\n\n" or rows["a.pdf"]["text"].startswith("本文")
    assert "| x |" in rows["a.pdf"]["text"] and rows["b.pdf"]["text"] is None and "broken" in rows["b.pdf"]["error"]


def test_input_by_suffix(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "x"}\n')
    (tmp_path / "b.pdf").write_bytes(b"stream\n(page) Tj\nendstream")
    assert [r["text"] for r in pdf.read_input(spark, str(tmp_path / "a.jsonl")).collect()] == ["x"]
    assert pdf.read_input(spark, str(tmp_path)).count() == 1 and pdf.read_input(spark, str(tmp_path / "b.pdf")).count() == 1
    with pytest.raises(ValueError, match="txt"):
        pdf.read_input(spark, str(tmp_path / "c.txt"))


def test_conversations_and_records(spark):
    df = spark.createDataFrame([(1, 2, "assistant", "b", 0), (1, 1, "user", "a", 0), (2, 1, "system", "s", 0), (2, 2, "user", None, 0), (None, 1, "user", "n", 0)], "k int, turn int, role string, content string, text int")
    got = {r["k"]: r["text"] for r in merge.conversations(df, "k", "turn", "role", "content").collect()}
    assert got[1].index(">user<") < got[1].index(">assistant<") and got[1].count("<|eot_id|>") == 3 and got[2].count("<|eot_id|>") == 1 and "n<|eot_id|>" in got[None]
    assert merge.conversations(df.limit(0), "k", "turn", "role", "content").count() == 0
    rows = lexicon.augmented(spark.createDataFrame([("t", None), ("u", "7")], "text string, id string"), "elaboration").collect()
    assert [(r["text"], r["augmentation_type"], r["source_id"]) for r in rows] == [("t", "elaboration", ""), ("u", "elaboration", "7")]


def test_checkpoints_need_a_shared_folder(spark):
    from corpusloom.session import checkpointed

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Frame:
        class sparkSession:
            sparkContext = Context()
            conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpointed(Frame)


def test_pipeline_resumes(spark, terms, tmp_path):
    base = spark.createDataFrame([(0, "軸受の話"), (1, "無関係")], "pos int, text string")
    steps = pipeline.steps(terms, None)
    first = pipeline.run(base, "keywords,dictionary,graph", steps, str(tmp_path))
    assert {r["source"] for r in first.collect()} == {"extract", "dictionary", "keywords"} and first.count() == 2 + 3 + 1
    calls = []
    again = pipeline.run(base, "keywords,dictionary", {k: (lambda df, k=k: calls.append(k) or steps[k](df)) for k in steps}, str(tmp_path))
    assert again.count() == first.count()


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, 5, "old"), ("a", 2, 6, "new"), ("a", 3, 6, "newer"), (None, 4, 1, "n"), (None, 5, 1, "m")], "id string, line_no int, loaded_at int, text string")
    assert sorted(r["text"] for r in tables.latest(df, "id").collect()) == ["m", "n", "newer"]


def test_all_steps_have_rows(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    rows = QUERIES["m5_steps"](spark, DATA).collect()
    n = {(r["step_rank"], r["source"]): r["n"] for r in rows}
    assert sorted(n) == list(enumerate(["extract", "dictionary", "elaboration", "generalized", "keywords", "qa", "english", "graph_relations"]))
    assert n[6, "english"] == n[0, "extract"] and n[5, "qa"] == 3 * n[4, "keywords"]


def test_quality_order(spark):
    safe = "one two three four five six seven eight nine ten"
    rows = [(0, safe + " a@b.jp"), (1, safe), (2, safe + " "), (3, "worse text"), (4, None), (5, "another one")]
    df = spark.createDataFrame(rows, "k int, text string")
    scorer = lambda xs: [1e9 if "worse" in x else 1.0 for x in xs]
    assert sorted(r["k"] for r in pipeline.quality_rows(df, "k", scorer).collect()) == [1, 5]  # row 0 isn't safe, so it makes row 1 no duplicate
    assert sorted(r["k"] for r in pipeline.quality_rows(df, "k").collect()) == [1, 3, 5]
    if os.path.isdir(DATA):
        ids = {name: {r["doc_id"] for r in QUERIES[name](spark, DATA).collect()} for name in ("q1_safe", "q4_perplexity", "q5_quality_rows")}
        assert ids["q5_quality_rows"] and ids["q5_quality_rows"] <= ids["q1_safe"] & ids["q4_perplexity"]


def test_cleaned_agrees_with_report(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    report = QUERIES["c17_cleaning_report"](spark, DATA).first()
    rows = QUERIES["c17_cleaned"](spark, DATA)
    assert rows.columns == ["line_no", "text"] and rows.count() == report["rows_out"] > 0
