"""Training-data operators against plain versions, round trips and hand-made cases."""

import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import containers, markup, mixing, neardup, pairs, scans, split, stuffing, tokens, visual

SENTENCES = ["装置の温度を測定した。", "結果を表に示す。", "圧力は徐々に増加する。", "The valve was opened slowly. ", "試験は三回行った。", "弁の寿命を比較した。", "流れの様子を観察した。"]


# --- 1 ---


def kinds(text):
    return markup.languages(text, markup.read([text])[0])


@pytest.mark.parametrize(
    "text,wanted",
    [
        ("本文の<b>強調</b>と&nbsp;空白", ["html"]),
        ("# 見出し\n\n本文です。", ["markdown"]),
        ("見出し\n=====\n本文です。", ["markdown"]),
        ("* **甲**: 1\n* **乙**: 2", ["markdown"]),
        ("== 見出し ==\n* [[甲]]の項", ["wiki"]),
        ("{{情報\n|名称=甲\n}}", ["wiki"]),
        ("値を $x_1 = \\frac{a}{b}$ とする。", ["latex"]),
        ("\\section{甲}\n% 注\n本文", ["latex"]),
        ("# 題\n\n式は $a^2$ である。", ["markdown", "latex"]),
        ("費用は $3145 から $5520 に増えた。#38 号機。", []),
        ("if a == b なら 0 <= k <= 5、5 * 3 * 2、f(x) = x^2", []),
        ("D:\\data\\run3\\log に置く。C# と C++、rotor_speed_max。", []),
        ("<!-- Page 3 -->\n\n・甲\n・乙\n- 18 -\n[9]", []),
        ("集合 { x | x > 14 }、|x| が 5 以下、入力 -> 出力", []),
        ("", []),
    ],
)
def test_markup_kinds(text, wanted):
    assert kinds(text) == wanted


def test_markup_held_out():
    rng = random.Random(4321)
    right = 0
    for _ in range(200):
        _, text, labels = markup.labelled_page(rng)
        right += set(kinds(text)) == {x for x in labels if x != "text"}
    assert right >= 190


def test_marginals_are_exact():
    """Messages give the same as summing over all labellings of a small tree."""
    from itertools import product

    m = markup.model()
    forms, block, page = np.array([_f("star"), _f("wiki_link"), _f("dash")]), np.array([0, 0, 1]), np.array([0, 0])
    got = markup.marginals(forms, block, page, m)
    k = len(markup.LABELS)
    want = np.zeros((3, k))
    for r, b0, b1, *leaf in product(range(k), repeat=6):
        logp = m.page[r] + m.block[r, b0] + m.block[r, b1] + sum(m.leaf[b, x] + m.form[x, f] for b, x, f in zip((b0, b0, b1), leaf, forms, strict=True))
        for i, x in enumerate(leaf):
            want[i, x] += np.exp(logp)
    assert np.allclose(got, want / want.sum(1, keepdims=True), atol=1e-9)


def _f(name):
    return markup.FORMS.index(name)


def test_clean_text_keeps_structure():
    t = markup.clean_text("<h2>題</h2><ul><li>甲</li><li>乙</li></ul><table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>x&lt;y", ["html"])
    assert "題" in t and "・甲\n・乙" in t and "a\tb\n1\t2" in t and t.endswith("x<y")
    t = markup.clean_text("## 題\n\n```c\nf(1);\n```\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n**甲**と[乙](http://x.y/z)", ["markdown"])
    assert t == "題\n\n    f(1);\n\na\tb\n1\t2\n\n甲と乙"
    t = markup.clean_text("== 題 ==\n'''甲'''は[[乙|丙]]である。{{要出典|2001年}}\n{|\n! a !! b\n|-\n| 1 || 2\n|}", ["wiki"])
    assert "題\n\n甲は丙である。" in t and "a\tb" in t and "1\t2" in t and "{|" not in t
    t = markup.clean_text("\\section{題}\n\\begin{itemize}\n\\item 甲\n\\end{itemize}\n値は $x^2$ で\\cite{r1}。", ["latex"])
    assert t.startswith("題") and "・甲" in t and "値は x^2 で[r1]。" in t


def cleaned(text):
    nodes = markup.read([text])[0]
    return markup.clean_text(text, markup.languages(text, nodes), nodes)


def test_code_and_formulas_come_out_untouched():
    code = "def __init__(self):\n- 1\n# no heading\nreturn x**2 + y**2 + `a` + <b>&lt;"
    assert cleaned(f"# 題\n\n```python\n{code}\n```\n\n本文の **強調**。") == "題\n\n" + "\n".join("    " + x for x in code.split("\n")) + "\n\n本文の 強調。"
    assert cleaned("\\section{題}\n\\begin{verbatim}\n% keep \\item\n  $x$ {y}\n\\end{verbatim}\n\\textbf{甲}") == "題\n\n    % keep \\item\n      $x$ {y}\n\n甲"
    assert cleaned("<p>次のとおり。</p><pre><code>- a\n*q* &lt;b&gt; `c`</code></pre>\n<ul><li>甲</li></ul>") == "次のとおり。\n\n    - a\n    *q* <b> `c`\n\n・甲"
    assert cleaned("\\section{A {\\bf b} c}\n本文\\footnote{甲の\\emph{乙}} である。") == "A b c\n\n本文（甲の乙） である。"
    assert cleaned("# 題\n\n値は `a_*b*_c` と $x_1 * y_2 = \\frac{a}{b}$ である。") == "題\n\n値は a_*b*_c と x_1 * y_2 = \\frac{a}{b} である。"
    assert cleaned("== 題 ==\n<nowiki>'''x''' [[y]]</nowiki>と'''甲'''") == "題\n\n'''x''' [[y]]と甲"
    assert cleaned("# 題\n\n\ue0100\ue011 の `x`") == "題\n\n\ue0100\ue011 の x"
    assert cleaned("\\section{題\n閉じない {") == "\\section{題\n閉じない {"


def test_long_templates_and_formulas():
    long = "甲" * 900
    assert kinds(f"値は $x_1 = {long}$ と {{{{情報|名称={long}}}}} である。\n\n== 題 ==") == ["wiki", "latex"]
    assert cleaned(f"== 題 ==\n{{{{情報|名称={{{{乙|{long}}}}}}}}}") == f"題\n\n{long}"


def test_content_stays_where_the_tree_says_so():
    """Stars, dollars and underscores of prose among another language's markup are content."""
    assert cleaned("<p>係数は 5 * 3 * 2、費用は $3145 から $5520、名前は get_item と max_value。</p>") == "係数は 5 * 3 * 2、費用は $3145 から $5520、名前は get_item と max_value。"


def test_markup_frames(spark):
    df = spark.createDataFrame([(1, "<p>a</p>", 0), (2, None, 0), (3, "", 0), (4, "素", 0)], "id int, text string, clean int")
    assert [tuple(r) for r in markup.found(df, "id").collect()] == [(1, "html")]
    got = {r["id"]: (r["clean"], r["markup"]) for r in markup.cleaned(df).collect()}
    assert got == {1: ("a", ["html"]), 2: (None, None), 3: ("", []), 4: ("素", [])} or got[2][0] is None
    assert markup.found(df.limit(0), "id").count() == 0


# --- 2 ---


@pytest.mark.parametrize("limit,overlap", [(1500, 100), (60, 10), (20, 0)])
def test_pieces_hold_the_text(limit, overlap):
    rng = random.Random(limit)
    bits = ["あ", "い。", "\n", "\n\n", " ", "a", "bc ", ". ", "　", "x" * 50, "<!-- Page 3 -->", "！", "\r\n"]
    for _ in range(200):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 120)))
        at = 0
        for start, new, end, _ in split.pieces_of(text, limit, overlap):
            assert end - start <= limit and new - start <= overlap and start <= new <= end and not text[at:new].strip()
            at = end
        assert not text[at:].strip()


def test_overlap_below_limit():
    for overlap in (20, 30, -1):
        with pytest.raises(ValueError, match="overlap"):
            split.pieces_of("あ" * 50, 20, overlap)


def test_cuts_are_natural():
    text = "\n\n".join("あ" * 700 for _ in range(6))
    assert {k for _, _, _, k in split.pieces_of(text)} == {"paragraph", "end"}
    assert split.Boundaries("あ" * 2000).falls_into(1400) == "none" and split.Boundaries(("い" * 900 + "。") * 3).falls_into(1400) == "sentence"
    assert split.Boundaries("あ" * 1300 + "\n" + "い" * 1300).falls_into(1400) == "line" and split.Boundaries(("あ" * 1400 + "\n 　\n") * 2).falls_into(1400) == "paragraph"
    assert split.Boundaries("v1.5 " * 400).falls_into(1400) == "none" and split.pieces_of(" \n ") == [(0, 0, 0, "end")]
    by = split.by_tokens(tokens.DEFAULT_PATH)
    text = "".join(SENTENCES) * 30
    size = by(text)
    assert size[-1] == len(tokens.encoder().encode_ordinary(text)) and all(size[e] - size[s] <= 64 for s, _, e, _ in split.pieces_of(text, 64, 8, by))


def test_split_frames(spark):
    meta = ("f", 1, "s", 1, 3, 1)
    text = "<!-- Page 1 -->\n\n" + "あ" * 1300 + "\n\n<!-- Page 2 -->\n\n" + "い" * 1200
    df = spark.createDataFrame([("a", text, meta), ("b", None, None), ("c", "短い", meta), ("d", "う" * 1501, None)], "id string, text string, meta struct<source_file:string,chunk_id:int,section_path:string,page_start:int,page_end:int,hierarchical_level:int>")
    rows = split.split_oversized(df).orderBy("id", "piece").collect()
    assert [(r["id"], r["piece"], r["pieces"], r["boundary"]) for r in rows] == [("a", 1, 2, "paragraph"), ("a", 2, 2, "paragraph"), ("d", 1, 2, "none"), ("d", 2, 2, "none")]
    assert (rows[0]["meta"]["page_start"], rows[0]["meta"]["page_end"]) == (1, 1) and rows[1]["meta"]["page_end"] == 2 and rows[2]["meta"] is None
    assert split.split_oversized(df.limit(0)).count() == 0


# --- 3 ---


def near_rows(n, seed):
    rng = random.Random(seed)
    alphabet = "あいうえおかきくけこさしすせそたちつてと装置温度圧力測定結果"
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            t = list(rng.choice(rows)[1])
            for _ in range(rng.choice([0, 1, 3, 8, 25])):
                t[rng.randrange(len(t))] = rng.choice(alphabet)
            rows.append((f"k{i}", "".join(t)))
        else:
            rows.append((f"k{i}", "".join(rng.choice(alphabet) for _ in range(rng.randint(200, 400)))))
    return rows


def test_near_pairs_and_groups(spark):
    rows = near_rows(150, 2)
    df = spark.createDataFrame([*rows, ("x", None), ("y", "短い"), (None, rows[0][1]), rows[3]], "id string, text string")
    want = {(min(a, b), max(a, b)) for i, (a, x) in enumerate(rows) for b, y in rows[:i] if neardup.similarity(x, y) >= 0.7}
    assert {tuple(r) for r in neardup.pairs(df).collect()} == want and len(want) > 20
    parent = {k: k for k, _ in rows}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in want:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["id"]: r for r in neardup.groups(df).collect()}
    text = dict(rows)
    assert len(got) == 150 and {k: got[k]["group"] for k in got} == {k: root(k) for k in text}
    for k, r in got.items():
        assert r["class"] == min(j for j in text if text[j] == text[k]) and r["copies"] == sum(t == text[k] for t in text.values())
        near = {text[j] for p in want if k in p for j in p} - {text[k]}
        assert r["links"] == len(near)
    assert neardup.pairs(df.limit(0)).count() == 0 and neardup.groups(df.limit(0)).count() == 0


def test_large_buckets_are_joined_in_parts(spark, monkeypatch):
    """A family of similar but unequal texts meets in the same buckets; parts of any size give the same pairs."""
    rng = random.Random(3)
    base = "".join(rng.choice("装置温度圧力測定結果弁寿命比較") for _ in range(300))
    rows = [(f"k{i:03}", base[: i % 290] + "甲乙丙丁"[i % 4] * (1 + i // 100) + base[i % 290 :]) for i in range(160)]
    df = spark.createDataFrame(rows, "id string, text string")
    want = {tuple(r) for r in neardup.pairs(df).collect()}
    assert len(want) > 10_000
    monkeypatch.setattr(neardup, "HOT", 9)
    assert {tuple(r) for r in neardup.pairs(df).collect()} == want


def test_many_copies_stay_one_class(spark):
    t = "装置の温度を測定して結果を表に示した。" * 12
    df = spark.range(3000).select(F.col("id").cast("string"), F.lit(t).alias("text"))
    g = neardup.groups(df)
    assert g.select("class").distinct().count() == 1 and g.first()["copies"] == 3000 and g.first()["links"] == 0


def test_signature_guarantee():
    """Two signatures within the guaranteed distance share a part with at most one error."""
    rng = np.random.default_rng(1)
    for _ in range(500):
        a = rng.integers(0, 9, neardup.CHUNKS * neardup.WIDTH)
        b = a.copy()
        b[rng.choice(len(a), 2 * neardup.CHUNKS - 1, replace=False)] += 100
        assert ((a != b).reshape(neardup.CHUNKS, neardup.WIDTH).sum(1) <= 1).any()


# --- 4 ---


def sample_pairs(n=1600, seed=6):
    """Pairs of a small made-up corpus, one in eight of them defective, as a table would hold them."""
    rng = random.Random(seed)
    subjects = [f"{a}{b}" for a in ("高速", "小型", "密閉", "電動", "空冷") for b in ("ポンプ", "軸受", "主軸", "送風機", "歯車", "センサ")]
    facts = ["{s}の温度は {n} °C まで上昇する。", "{s}を停止すると振動が減少する。", "{s}の寿命は荷重に大きく依存する。", "試験では{s}に異常は見られなかった。", "{s}の表面を青銅で被覆する。", "{s}と{t}を直列に接続すると流量が {n} L/min だけ変わる。", "一概には言えませんが、{s}では {n} MPa 前後になります。", "{s}だけでは応力を直接測ることはできません。そこで{t}の温度から推定します。"]
    out = []
    for _ in range(n):
        s = rng.choice(subjects)
        q = rng.choice([f"{s}の寿命に影響する要因は何ですか?", f"{s}が停止する理由を説明してください。", f"{s}の温度はいくらですか?", f"{s}では逆流が生じますか?"])
        a = "".join(rng.choice(facts).format(s=rng.choice(subjects), t=rng.choice(subjects), n=rng.randint(2, 900)) for _ in range(rng.randint(1, 3)))
        a = rng.choice([a, a, a, f"{rng.randint(1, 900)} °C", f"約 {rng.randint(1, 90)} mm です。", "はい。", "生じない。", "次のとおりである。\n・主軸の点検\n・軸受の交換"])
        if rng.random() < 0.12:
            a = rng.choice([q, "N/A", "", "申し訳ありませんが、お答えできません。", f"{s}については、当社の方針で公表を控えております。", a[: len(a) // 2] + "の", "The bearing was replaced after ten hours of use."])
        out.append((q, a))
    return out


@pytest.fixture(scope="module")
def pair_model():
    return pairs.train(sample_pairs())


def test_broken_pairs(pair_model):
    q = "密閉軸受の寿命に影響する要因は何ですか?"
    cases = [
        (q, None, "empty"), (q, " ", "empty"), (q, "N/A", "empty"), (q, "未回答", "empty"), (q, '{"answer": ""}', "empty"),
        (q, "申し訳ありませんが、お答えできません。", "refusal"), (q, "I'm sorry, but I can't help with that.", "refusal"),
        (q, q, "copy"), (q, f"質問: {q}", "copy"), (q, "密閉軸受の寿命に影響する要因は何でしょうか", "copy"),
        (q, "The bearing was replaced after ten hours of use and no damage was found.", "language"), (q, "轴承的寿命主要取决于载荷和润滑条件。", "language"),
        (q, "密閉軸受の寿命は荷重に大きく依存する。高速ポンプの温度は", "truncated"),
        (q, "密閉軸受の寿命は荷重に大きく依存する。", None), (q, "45 °C", None), ("英語で説明してください: 軸受の寿命", "The life of the bearing depends on the load.", None), (q, "次のとおりである。\n・主軸の点検\n・軸受の交換", None), (None, "高速ポンプの温度は 45 °C まで上昇する。", None),
    ]
    got = pairs.classify(pair_model, [(a, b) for a, b, _ in cases])
    assert sum(g == w for g, (_, _, w) in zip(got, cases, strict=True)) >= len(cases) - 1, list(zip(got, cases))


#: Wordings that stand neither in the parts the operator learns from nor in the sample.
HELD_OUT = {
    "refusal": ["No comment.", "教えることは控えたいと思います。", "機密事項のため非公開です。", "当社の規則で公表が禁じられています。", "あいにく手元に資料が無く、申し上げることができません。", "そのご要望には添いかねます。", "その手の質問には応じない方針です。", "申し上げる立場にありません。", "I have no information about that.", "That's not something I am able to share.", "Sorry, but that is restricted information.", "We are unable to respond at this time.", "我没有相关资料,难以回答。", "죄송하지만 말씀드리기 어렵습니다.", "Désolé, je n'ai pas cette information.", "情報不足のため、お答えは致しかねます。", "残念ですが、この点についての説明はご容赦願います。", "この資料だけでは何とも申し上げられません。", "ご質問の件は、弊社の都合によりお伝えすることができません。"],
    "empty": ["記載なし", "N.A.", "準備中", "pending", "<p></p>", "該当なし。", "(未記入)", "--", "後日回答予定", "未確定", "(no answer provided)", "None", "答えなし", "暂缺", "*", "<br/>", "　\n", "回答:（空白）"],
    "copy": ["密閉軸受の寿命に影響する要因は何でしょうか。", "密閉軸受の寿命に影響する要因についてのご質問ですね。", "密閉軸受の寿命に影響する要因を教えてほしいということですね。", "ご質問: 密閉軸受の寿命に影響する要因は何ですか?", "お尋ねの件:「密閉軸受の寿命に影響する要因は何ですか?」", "あなたの質問は「密閉軸受の寿命に影響する要因は何ですか」です。"],
    "language": ["Smar na łożysku zmniejsza tarcie i zwiększa trwałość.", "Tuổi thọ của ổ trục phụ thuộc vào tải trọng.", "อายุการใช้งานของตลับลูกปืนขึ้นอยู่กับภาระ", "חיי המסב תלויים בעומס ובשימון.", "बेयरिंग का जीवन भार पर निर्भर करता है।", "La durata del cuscinetto dipende dal carico e dalla lubrificazione.", "Срок службы подшипника зависит от нагрузки.", "يعتمد عمر المحمل على الحمل.", "Η διάρκεια ζωής του ρουλεμάν εξαρτάται από το φορτίο."],
    "truncated": ["主な要因は三つある。第一に荷重、第二に", "・荷重の大きさ\n・潤滑の状態\n・温度が", "密閉軸受の寿命は潤滑油の種類によって変わり、粘度が低いほ", "密閉軸受の寿命は荷重に大きく依存し、特に"],
    None: ["密閉軸受の寿命は荷重に大きく依存する。", "荷重です。", "荷重と温度", "はい。", "45 °C", "変化なし", "次のとおりである。\n・主軸の点検\n・軸受の交換", "分解せずに寿命を知ることはできません。そのため温度から推定します。", "不具合は見られません。", "荷重が大きいほど寿命は短くなる。"],
}


def test_broken_pairs_in_other_words(pair_model):
    q = "密閉軸受の寿命に影響する要因は何ですか?"
    for want, answers in HELD_OUT.items():
        got = pairs.classify(pair_model, [(q, a) for a in answers])
        assert sum(g == want for g in got) >= 0.75 * len(answers), [(g, a) for g, a in zip(got, answers, strict=True) if g != want]


def test_pair_features_one_by_one():
    """A batch gives each pair the features it has alone."""
    some = sample_pairs(60, 2) + [(None, None), ("", ""), ("何?", "\0a\0"), ("x" * 500, "y " * 3000)]
    model = pairs.Model({(n, k): np.random.default_rng(1).normal(size=pairs.SIZES[k]).astype(np.float32) for n, (ks, _) in pairs.READS.items() for k in ks}, np.ones((len(pairs.DENSE), len(pairs.DEFECTS))), pairs.familiar_grams([a for _, a in some if a]), np.ones(5), np.zeros(5))
    whole = pairs.features(some, model.familiar)
    together = pairs.scores(model.grams, model.dense, whole)
    for i, p in enumerate(some):
        one = pairs.features([p], model.familiar)
        assert np.allclose(one.dense[0], whole.dense[i]) and np.allclose(pairs.scores(model.grams, model.dense, one)[0], together[i], atol=1e-4), p


def test_pair_frames(spark):
    df = spark.createDataFrame([(1, "これは何ですか?", "装置の温度を測定した。", "a"), (2, None, None, "b"), (3, "", "", None)], "pair_id long, question string, answer string, defect string")
    got = {r["pair_id"]: r["defect"] for r in pairs.defects(df).collect()}
    assert got.get(2) == "empty" and got.get(3) == "empty"
    assert pairs.defects(df.limit(0)).count() == 0


# --- 5 ---


def test_canonical_is_nfkc_where_nothing_else_is_mapped():
    rng = random.Random(1)
    spans = [range(0x20, 0x7F), range(0xC0, 0x180), range(0x300, 0x345), range(0x3041, 0x30FF), range(0xFF61, 0xFFA0), range(0x1100, 0x1112), range(0x1161, 0x1176), range(0x11A8, 0x11C3), range(0xAC00, 0xAC40), range(0x1E00, 0x1F00), range(0x2F00, 0x2F40)]
    letters = [chr(c) for s in spans for c in s if chr(c) not in "゛゜" and chr(c) not in visual.INVISIBLE]
    given = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(5000)] + [None]
    assert visual.canonical_array(pa.array(given)).to_pylist() == [None if x is None else unicodedata.normalize("NFKC", x) for x in given]


def test_canonical_maps_what_looks_the_same():
    assert visual.canonical("ﬂаngе\u00a0Ｔｏｒｑｕｅ‐１\u200b量\ufe00⾦ﾎﾟﾝﾌﾟカ゛") == "flange Torque-1量金ポンプガ"
    assert visual.canonical("ー一") == "ー一" and visual.canonical("A a") != visual.canonical("a a") and visual.canonical("a\nb") == "a\nb"


def test_same_looking(spark):
    a = spark.createDataFrame([("a", "ポンプ A"), ("b", "ポンプ A"), ("c", None), ("d", " "), ("e", "ポンプ B"), ("a", "ポンプ A")], "id string, text string")
    b = spark.createDataFrame([(1, "ﾎﾟﾝﾌﾟ\u00a0А"), (2, "ポンプ A"), (3, None), (4, "\u3000"), (5, "ポンプ  A")], "result_id long, text string")
    assert sorted(map(tuple, visual.same_looking(a, b, "id", "result_id").collect())) == [("a", 1), ("b", 1)]
    assert visual.same_looking(a.limit(0), b, "id", "result_id").count() == 0
    c = visual.with_canonical(a.withColumn("canonical", F.lit(0)))
    assert c.columns == ["id", "text", "canonical"] and c.where("text is null").first()["canonical"] is None


# --- 6 ---


def scan_frame(spark):
    words = ["シリンダ", "ロータ", "ステータ", "ポンプ", "ノズル"]
    body = [f"{w}の温度は {i % 90} °C で、圧力が緩やかに上昇する。冷却器の熱流束を測定した。" for i, w in enumerate(words * 60)]
    rows = [(f"k{i}", t, "f.pdf") for i, t in enumerate(body)]
    rows += [
        ("n1", "技術報告 第一号\nロータの温度を測\n定した。\n- 12 -\n圧力が緩やかに", "f.pdf"), ("n2", "ロ一タの温度と熟流束を測定した。", "f.pdf"), ("n3", "the tempera-\nture was mea-\nsured", "f.pdf"),
        ("n4", "測定値 (mm)\n612\n490\n305", "f.pdf"), ("n5", "圧力は 2O5 kPa であった。", "f.pdf"), ("n6", None, "f.pdf"), ("n7", "技 術報告 第一号  第4章\n本文である。", "f.pdf"), ("n8", "技術報告 第一号\n本文", None),
    ]
    files = spark.createDataFrame([("f.pdf", "技術報告 第一号", "技報")], "source_file string, title string, short_title string")
    return spark.createDataFrame(rows, "id string, text string, source_file string"), files


def test_scan_noise(spark, monkeypatch):
    df, files = scan_frame(spark)
    got = {}
    for r in scans.noise(df, files).collect():
        got.setdefault(r["id"], set()).add(r["noise"])
    assert got == {"n1": {"header", "page_number"}, "n2": {"misread"}, "n3": {"hyphen"}, "n5": {"misread"}, "n7": {"header"}}
    monkeypatch.setattr(scans, "MOST_TITLES", 0)  # too many titles to send: the join gives the same
    again = {}
    for r in scans.noise(df, files).collect():
        again.setdefault(r["id"], set()).add(r["noise"])
    assert again == got
    assert scans.noise(df.limit(0), files).count() == 0


def test_scan_repair(spark):
    df, files = scan_frame(spark)
    got = {r["id"]: r["repaired"] for r in scans.repaired(df, files).collect()}
    assert got["n1"] == "ロータの温度を測定した。\n圧力が緩やかに" and got["n2"] == "ロータの温度と熱流束を測定した。" and got["n6"] is None
    assert got["n3"].split() == ["the", "temperature", "was", "measured"] and got["n4"] == "測定値 (mm)\n612\n490\n305"


def test_scan_copies_dont_make_a_form_sound(spark):
    df, files = scan_frame(spark)
    copies = spark.range(160).select(F.concat(F.lit("c"), "id").alias("id"), F.lit("ロ一タの温度と熟流束を測定した。").alias("text"), F.lit("f.pdf").alias("source_file"))
    df = df.unionByName(copies)  # a third of all rows
    found = {r["id"] for r in scans.noise(df, files).where("noise = 'misread'").collect()}
    assert found == {"n2", "n5"} | {f"c{i}" for i in range(160)}
    fixed = scans.repaired(df, files).where("id like 'c%'").groupBy("repaired").count().collect()
    assert [tuple(r) for r in fixed] == [("ロータの温度と熱流束を測定した。", 160)]


def test_scan_words_of_any_corpus_size(spark, monkeypatch):
    monkeypatch.setattr(scans, "MOST_WORDS", 5, raising=False)  # was a bound that a corpus of this size would reach
    df, files = scan_frame(spark)
    assert {r["id"] for r in scans.noise(df, files).where("noise = 'misread'").collect()} == {"n2", "n5"}
    texts = scans.distinct_texts(df)
    found = scans.links(scans.count_units(texts)).collect()
    assert {(r["form"], r["word"]) for r in found} >= {("ロ一タ", "ロータ"), (">熟流", ">熱流")}
    monkeypatch.setattr(scans, "TOGETHER", 1)  # links in several groups: none is lost
    rows = spark.createDataFrame(found)
    assert {tuple(r) for r in scans.fitting(texts, rows, fit=-1e9).collect()} == {(r["form"], r["word"]) for r in found}


def test_scan_links_dont_depend_on_the_size(spark):
    """A corpus of a thousand times as many texts has the same links; a katakana word may have any number of doubtful letters."""
    rows = [("コンピュータシミュレーション", 900), ("コソピュータツミュレーツョソ", 3), ("ポンプ", 400), ("ポソプ", 2), ("ダクト", 40), ("compressor", 300), ("cornpressor", 4), ("<の熱", 90), ("<の熟", 1), ("ツール", 50), ("シール", 60)]
    want = {("コソピュータツミュレーツョソ", "コンピュータシミュレーション"), ("ポソプ", "ポンプ"), ("cornpressor", "compressor"), ("<の熟", "<の熱")}
    for times in (1, 1000):
        units = spark.createDataFrame([(u, n * times) for u, n in rows], "unit string, n long")
        assert {(r["form"], r["word"]) for r in scans.links(units).collect()} == want


def test_scan_heads_of_any_form(spark, monkeypatch):
    """Long titles, titles with a full stop and lines with any kind of blanks, whether titles are sent or joined."""
    long = "回転機械の振動と騒音に関する調査報告書。" * 7
    files = spark.createDataFrame([("f.pdf", long, "振動 技報"), (None, "x", "y"), ("g.pdf", None, "別の表題")], "source_file string, title string, short_title string")
    rows = [("a", f"{long}\n本文。", "f.pdf"), ("b", f"本文\n振動\u2003技\u00a0報 {' ' * 200} 12", "f.pdf"), ("c", f"本文中の{long}である", "f.pdf"), ("d", "振動技報", "g.pdf"), ("e", "", "f.pdf"), ("f", "別の表題\n文", "g.pdf")]
    df = spark.createDataFrame(rows, "id string, text string, source_file string")
    lexicon = scans.learn(df)
    for most in (200_000, 0):
        monkeypatch.setattr(scans, "MOST_TITLES", most)
        assert {r["id"] for r in scans.noise(df, files, lexicon).where("noise = 'header'").collect()} == {"a", "b", "f"}
        fixed = {r["id"]: r["repaired"] for r in scans.repaired(df, files, lexicon).collect()}
        assert fixed["a"] == "本文。" and fixed["b"] == "本文" and fixed["d"] == "振動技報" and fixed["e"] == ""


def test_scan_heads_among_many_titles(spark):
    """Whether titles are sent or by a filter, just the lines that fold to one are let through, and folding takes no longer for long numbers."""
    assert scans.fold_title("1" * 60 + "軸受の報告") == "軸受の報告" and scans.fold_title("技術報告" + "7" * 60 + "x") == "技術報告" + "7" * 60 + "x"
    heads = spark.createDataFrame([(f"f{i}.pdf", scans.fold_title(t)) for i, t in enumerate(["技術報告 第一号", "SoIl Report", "回転機械の振動"])], "file string, head string")
    titles = {r["head"] for r in heads.collect()}
    rng = random.Random(3)
    lines = ["技術報告 第一号", "P.3 技 術報告第一号", "回転機械の振動 第4章 - 12", "Vol.7 回転機械の振動", "回転機械の振動は", "So1l\u2003Report|", "", "本文。", "\ud800", "1" * 60, "(2024年)", "熟", "\0"]
    texts = [None, "", *("\n".join(rng.choice(lines) for _ in range(rng.randint(1, 6))) for _ in range(300))]
    want = sorted((i, h) for i, x in enumerate(texts) if x for h in map(scans.fold_title, x.split("\n")) if h in titles)
    for known in (scans.Heads.of(sorted(titles)), scans.Heads.filtered(heads)):
        assert sorted(known.found(texts)) == want and list(known.found([None, ""])) == []
    assert list(scans.Heads.of([]).found(texts)) == list(scans.Heads.filtered(heads.limit(0)).found(texts)) == []


def test_scan_lines_with_many_blanks():
    words = scans.Batch(["熱交換" + " " * 5000 + "\n" + "　" * 3000 + "器 tempera-" + " " * 99 + "\n" + " " * 99 + "ture"])
    assert [words.text(k) for k in range(len(words.start))] == ["熱交換器", "temperature"]


def test_page_lines():
    yes = ["12", "  12  ", "- 3 -", "— 14 —", "−5−", "・7・", "3/53", "P.3", "p. 7", "Page 595", "58ページ", "21 頁", "[28]", "〔300〕"]
    no = ["3.5", "12 mm", "第1章", "・3", "<!-- Page 3 -->", "2013年", "", "a1", "1,2,3"]
    assert all(scans.page_lines([x]) == [True] for x in yes) and all(scans.page_lines([x]) == [False] for x in no)
    assert scans.page_lines(["値 (mm)", "1", "2", "x", "7", "y"]) == [False, False, False, False, True, False]


def test_word_hash():
    b = scans.Batch(["動力ダクトはHello Wor-\nld 熱交換\n器", "スピソドルA5052"])
    assert [b.text(k) for k in range(len(b.start))] == ["動", "力ダクト", "hello", "world", "熱交換器", "スピソドル", "a5052"]
    assert all(int(b.hash[k]) == scans.word_hash(b.text(k)) for k in range(len(b.start))) and b.doc.tolist() == [0, 0, 0, 0, 0, 1, 1]


# --- 7 ---


def test_closest_is_best():
    rng = random.Random(8)
    for _ in range(300):
        counts = {rng.randint(1, 12): rng.randint(1, 4) for _ in range(rng.randint(0, 5))}
        room = rng.randint(0, 40)
        best = {0}
        for length, n in counts.items():
            best = {s + k * length for s in best for k in range(n + 1) if s + k * length <= room}
        used = dict(containers.closest(counts, room))
        assert sum(k * n for k, n in used.items()) == max(best) and all(n <= counts[k] for k, n in used.items())


def test_containers(spark):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice(SENTENCES) for _ in range(rng.choice([1, 2, 5, 9, 40])))) for i in range(300)] + [(900, None), (901, ""), (902, "装置の温度" * 9)] + [(1000 + i, "同じ文。") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a = containers.fill(df, 128).cache()
    size = {i: len(tokens.encoder().encode_ordinary(t)) if t else 0 for i, t in rows}
    own = {}
    for r in a.collect():
        own.setdefault(r["doc_id"], []).append((r["piece"], r["first"], r["size"]))
    assert set(own) == set(size)
    for i, ps in own.items():
        ps.sort()
        assert len(ps) == max(1, -(-size[i] // 128)) and sum(s for _, _, s in ps) == size[i] and [f for _, f, _ in ps] == [128 * k for k in range(len(ps))]
    f = containers.filled(a, 128).collect()
    assert max(r["fill"] for r in f) <= 128 and len(f) == -(-sum(size.values()) // 128)
    assert containers.fill(df.limit(0)).count() == 0


# --- 8 ---


def test_mixing(spark):
    rng = random.Random(10)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", "x", None]), "".join(rng.choice(SENTENCES) for _ in range(rng.randint(1, 4)))) for i in range(900)] + [(2000, "d", SENTENCES[0] * 5), (2001, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 4), ("c", 0.15, 3), ("none", 0.05, 2)], "source string, target_share double, max_repeats int")
    m = mixing.mix(docs, targets).cache()
    got = m.orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, len(got) + 1)) and all(x["moment"] <= y["moment"] for x, y in zip(got, got[1:], strict=False))
    assert {r["source"] for r in got} == {"a", "b", "c"} and len({(r["doc_id"], r["repeat"]) for r in got}) == len(got)
    s = {r["source"]: r for r in mixing.shares(m, targets).collect()}
    for k, want in (("a", 0.5), ("b", 0.3), ("c", 0.15)):
        assert abs(s[k]["share"] - want / 0.95) < 0.002 and s[k]["most_repeats"] <= s[k]["max_repeats"]
    assert s["none"]["share"] == 0 and any(s[k]["most_repeats"] == s[k]["max_repeats"] for k in "abc")
    assert mixing.mix(docs.limit(0), targets).count() == 0
    other = mixing.mix(docs, targets, "/opt/tokenizers/byte_bpe_50k.tiktoken").groupBy("doc_id").agg(F.max("tokens").alias("n")).collect()
    text = {i: t for i, _, t in rows}
    tool = tokens.encoder("/opt/tokenizers/byte_bpe_50k.tiktoken")
    assert other and all(r["n"] == len(tool.encode_ordinary(text[r["doc_id"]] or "")) for r in other)


def test_schedule_adds_up():
    shares = {"a": 0.2, "b": 0.5, "c": 0.3}
    tilt = mixing.tilts(shares)
    assert abs(sum(shares[k] * tilt[k] for k in shares)) < 1e-12 and max(map(abs, tilt.values())) <= 0.5 and mixing.tilts({"a": 1.0}) == {"a": 0.0}


# --- 9 ---


def plain_repeats(text, shortest, often):
    """Characters inside any substring of at least ``shortest`` that occurs ``often`` times and counts as a keyword."""
    n, inside = len(text), set()
    for i in range(n):
        for j in range(i + shortest, n + 1):
            s = text[i:j]
            occ = sum(text.startswith(s, k) for k in range(n))
            if occ < often:
                break
            # the maximal string with the same places: extended to the left while all occurrences agree
            places = [k for k in range(n) if text.startswith(s, k)]
            left = 0
            while all(k - left > 0 for k in places) and len({text[k - left - 1] for k in places}) == 1:
                left += 1
            whole = text[places[0] - left : places[0] + len(s)]
            bare = whole.strip()
            if len(bare) >= shortest and (len(bare) >= 4 or not bare.isascii()) and not stuffing._FILLER.fullmatch(bare):
                for k in places:
                    inside.update(range(k - left, k + len(s)))
    solid = [k for k in range(n) if not text[k].isspace()]
    return sum(k in inside for k in solid) / max(1, len(solid))


def test_automaton_against_brute_force():
    rng = random.Random(12)
    texts = ["".join(rng.choice("軸受弁a あ、") for _ in range(rng.randint(0, 40))) for _ in range(200)] + ["軸受 " * 30, "aaaa" * 20, "abcabcabcabd" * 4, "軸\0受 " * 9]
    got = stuffing.keywords(texts).coverage
    for text, coverage in zip(texts, got, strict=True):
        assert abs(coverage - plain_repeats(text.replace("\0", " "), 2, 3)) < 1e-9, text
    assert np.allclose(got, [stuffing.keywords([x]).coverage[0] for x in texts])  # a page's measures don't depend on its batch


def test_states_of_the_automaton():
    """Ends and lengths are those of the classes of substrings with the same end positions."""
    rng = random.Random(4)
    for _ in range(60):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 30)))
        classes: dict[tuple[int, ...], int] = {}
        for i in range(len(text)):
            for k in range(i + 2, len(text) + 1):
                w = text[i:k]
                ends = tuple(e for e in range(len(w), len(text) + 1) if text[e - len(w) : e] == w)
                if len(ends) >= 3:
                    classes[ends] = max(classes.get(ends, 0), len(w))
        s = stuffing.states(stuffing.join([text]))
        assert {tuple(sorted(s.ends[a : b + 1].tolist())): n for a, b, n in zip(s.left, s.right, s.length.tolist(), strict=True)} == classes, text


def test_every_keyword_is_tried():
    """Clauses stuffed with any of many keywords, long ones and parts of words among them."""
    names = ["USB hub", "LED kit", "bearing", "5号機", "高精度精密減速機用密閉型玉軸受", *(f"製品{c}型" for c in "あい")]
    text = "\n".join(f"{k}は{k}、{k}なら{k}の{k}を使う。" * 4 for k in names)
    lines = stuffing.parse(text)
    spans = [c for line in lines for c in line.clauses]
    got = stuffing.keywords([text], (np.array([b for b, _ in spans]), np.array([e for _, e in spans]))).stuffed
    assert len(got) == 4 * len(names) and got.all()


def test_clauses_are_stuffed_however_long_the_page():
    """Sentences each stuffed with a word of its own are found, though each word is rare in the whole page."""
    rng = random.Random(9)
    names = ["".join(chr(rng.randint(0x4E00, 0x9FA0)) for _ in range(5)) for _ in range(400)]
    ends = ["点検する", "測る", "使う", "調べる", "求める", "比べる"]
    for n in (5, 60, 400):
        stuffed = [f"{k}{rng.choice('はも')}{k}{rng.choice('のと')}{k}を{k}で{rng.choice(ends)}。" for k in names[:n]]
        plain = [f"第{i}の装置では、温度が{rng.randint(10, 99)}度に上昇した後で{rng.choice(ends)}。" for i in range(n)]
        text = "\n".join(x for both in zip(stuffed, plain, strict=True) for x in both)
        spans = [c for line in stuffing.parse(text) for c in line.clauses]
        got = stuffing.keywords([text], (np.array([b for b, _ in spans]), np.array([e for _, e in spans]))).stuffed
        assert got.tolist() == [True, False] * n
        assert stuffing.measure(["\n".join(stuffed)])[0].score > 0.5


def test_stuffed_clauses_against_brute_force(monkeypatch):
    """Overlapping occurrences count as they are read, however many strings are tried at once."""
    rng = random.Random(6)
    texts = ["".join(rng.choice("軸受a5、") for _ in range(rng.randint(1, 60))) for _ in range(60)] + ["軸受軸受軸受軸受軸", "軸" * 30]
    joined = "\0".join(texts) + "\0"
    spans, at = [], 0
    for x in texts:
        cuts = sorted({0, len(x), *(rng.randint(0, len(x)) for _ in range(3))})
        spans += [(at + a, at + b) for a, b in zip(cuts, cuts[1:])]
        at += len(x) + 1
    want = []
    for b, e in spans:
        page = joined[joined.rfind("\0", 0, b) + 1 : joined.find("\0", b)]
        words = set()
        for w in {page[i:k] for i in range(len(page)) for k in range(i + 2, len(page) + 1)}:
            places = [i for i in range(len(page)) if page.startswith(w, i)]
            if len(places) >= 3:
                left = 0  # the maximal string with the same ends
                while places[0] > left and len({page[i - left - 1] for i in places}) == 1:
                    left += 1
                words.add(page[places[0] - left : places[0]] + w)
        words = [w for w in words if (len(w) >= 4 or not w.isascii()) and not stuffing._FILLER.fullmatch(w)]
        want.append(any((n := joined[b:e].count(w)) >= stuffing.TIMES and n * len(w) >= stuffing.SHARE * (e - b) for w in words))
    for together in (1, 100, 1 << 19):
        monkeypatch.setattr(stuffing, "_TOGETHER", together, raising=False)
        got = stuffing.keywords(texts, (np.array([b for b, _ in spans]), np.array([e for _, e in spans]))).stuffed
        assert got.tolist() == want
    assert 9 < sum(want) < len(want)


def test_english_sentences_beside_other_signs():
    """A degree sign or Japanese text in the line makes no one clause of several sentences."""
    text = "Results agree with the bench test within 99 MPa. Results agree with the bench test within 5°C of it. Results agree with the bench test."
    assert [text[b:e].split()[-1] for line in stuffing.parse(text) for b, e in line.clauses] == ["MPa.", "it.", "test."]
    text = "Results agree with the test in the lab.Results agree with the test in the lab.試験の結果を表に示す。"
    assert [text[b:e][:7] for line in stuffing.parse(text) for b, e in line.clauses] == ["Results", "Results"]


def test_very_long_pages():
    for text in ("あ" * 300_000, "軸受は" * 60_000, "装置の温度を測定した。" * 20_000):
        assert stuffing.measure([text])[0].score >= 0


@pytest.mark.parametrize(
    "text,stuffed",
    [
        ("格安 激安 軸受 通販 軸受 人気 格安 軸受 最安値 比較 軸受 通販 格安 " * 8, True),
        ("#軸受 #工具 #ポンプ #軸受激安 " * 12, True),
        ("\n".join(f"- 軸受{i} https://a.example/p/{i}" for i in range(20)), True),
        ("\n".join(f"ABC-{i * 37} | 高速軸受 | 詳細" for i in range(20)), True),
        ("軸受は軸受、軸受も軸受、格安の軸受。当軸受の軸受は軸受通販に強い軸受です。" * 8, True),
        ("best cheap pump buy pump online sale pump shipping cheap pump " * 8, True),
        ("装置の温度を測定した。圧力は徐々に増加する。弁の寿命を比較した。" * 6, False),
        ("この軸受は小型軸受とも呼ばれる。軸受を選ぶときは、荷重も確かめる必要がある。" * 6, False),
        ("目次\n" + "\n".join(f"第{i}章 装置の概要 ...... {i * 3}" for i in range(1, 15)), False),
        ("\n".join(f"[{i}] 軸受における摩耗の解析、機械集報、200{i}年、第{i}巻、{i * 7}ページ。" for i in range(1, 9)), False),
        ("仕様\n" + "\n".join(f"消費電力{i}: {i}.5 kW" for i in range(20)), False),
        ("The valve was opened slowly and the pressure was measured at the outlet. It is stable." * 5, False),
        ("更换主轴之前,必须先检查响应时间是否正常。试验表明,轴承的功耗是稳定的。" * 4, False),
        ("", False),
        (None, False),
    ],
)
def test_stuffed_pages(spark, text, stuffed):
    assert (stuffing.measure([text or ""])[0].score > 0.5) == stuffed


def test_page_frames(spark):
    df = spark.createDataFrame([(1, None, 3.0), (2, "", 1.0), (3, "軸受 " * 60, 2.0), (4, "あ" * 300_000, 0.0)], "doc_id long, text string, score double")
    got = {r["doc_id"]: r["stuffed"] for r in stuffing.pages(df).collect()}
    assert got[1] is False and got[2] is False and got[3] is True and len(got) == 4
    assert stuffing.pages(df.limit(0)).count() == 0


# --- the boundary of the subpackage ---


def test_nothing_else_imports_it():
    import pathlib

    root = pathlib.Path(__file__).resolve().parents[2]
    for p in (root / "corpusloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"corpusloom\.llm|from \.llm|import llm", p.read_text()), p
