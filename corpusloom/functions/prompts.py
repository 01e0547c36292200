"""Prompts and answers of text generators.

The prompts are fixed values: generators give the same answers only for the
same wording. Variables are in braces; ``{{`` and ``}}`` stand for braces.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# System prompts by name.
SYSTEM = {
    "qa_difficult": """あなたは専門的なQ&Aを生成する専門家です。

与えられたテキストと専門用語辞書の情報を基に、専門知識が必要な難しい質問と回答のペアを生成してください。

ルール:
- テキストの内容と辞書の専門用語情報を組み合わせて質問を作成する
- 質問は専門用語や業界知識を理解していないと答えられないレベルにする
- 回答は辞書の定義とテキストの内容を基に、詳細かつ正確に記述する
- 3〜5個のQ&Aペアを生成する

質問の種類の例:
- 専門用語の意味を問う質問（「〜とは何ですか」）
- 概念間の関係を問う質問（「〜と〜の関係は」）
- 技術的な仕組みを問う質問（「〜はどのように機能しますか」）
- 応用や実例を問う質問（「〜はどのような場面で使われますか」）
""",
    "english_translation": """You are a professional translator.
Translate the given Japanese text to English accurately while preserving:
- Technical terminology
- Document structure (markdown, HTML tags, etc.)
- Numbers and data
- Formatting and line breaks

Provide natural, fluent English translation.""",
    "graph_relations": """あなたは専門用語の関係性を自然な日本語文にまとめる専門家です。

与えられた用語とその関係情報を、自然で読みやすい日本語の文章にまとめてください。

ルール:
- 関係タイプの意味を理解し、適切な日本語表現に変換する
- 同じタイプの関係は1文にまとめる（例: 「〜は〜や〜に適用される」）
- 指定された文字数程度で簡潔にまとめる
- 専門用語はそのまま使用する
- 冗長な表現を避け、情報密度の高い文章にする

関係タイプの例:
- RELATED_TO: 関連している
- APPLIES_TO: 適用される、使用される
- IS_A: 〜の一種である、〜に分類される
- AFFECTS: 影響を与える
- HAS_ATTRIBUTE: 〜という特性を持つ
- PART_OF: 〜の一部である
- BELONGS_TO_CATEGORY: 〜に分類される
""",
    "llama3_assistant": "あなたは誠実で有能な日本語のAIアシスタントです。ユーザーの質問に対して、正確で役立つ回答を提供してください。",
}

# User prompts by name.
USER = {
    "image_description": """この画像を分析してください。
もし画像が主に枠で囲まれたテキストである場合、"TEXT_ONLY:"という接頭辞に続けて、画像内のテキストを全て書き起こしてください。
それ以外の場合は、この画像の内容を統合報告書に掲載するキャプションとして、以下の形式で簡潔に日本語で説明してください。

- **種類**: 画像の種類を特定します（例: 製品写真, ウェブサイトのスクリーンショット, ロゴ, グラフ, 表）。
- **内容**: 画像に写っている主要な要素や情報を客観的に記述します。
- **示唆**: (任意) この画像がビジネスや経営において持つ可能性のある意味や示唆を簡潔に述べます。

説明は客観的かつ簡潔にまとめてください。""",
    "paraphrase": "以下の文章を、元の意味を完全に保持したまま、異なる表現で言い換えてください。言い換えた後の文章のみを出力してください。\n\n# 元の文章:\n{text}",
    "qa": """以下の文章に基づいて、質の高い質問と回答を1ペア生成してください。
出力は以下のJSON形式で:
```json
{{"question": "質問", "answer": "回答"}}
```

# 文章:
{context}""",
    "summary": "以下の文章を{max_length}文字程度で簡潔に要約してください。\n\n# 文章:\n{text}",
    "keywords": """以下の文章から重要なキーワードを5つ抽出し、説明を付けてください。
出力は以下のJSON形式で:
```json
[{{"keyword": "キーワード", "description": "説明"}}]
```

# 文章:
{text}""",
    "elaboration": "以下の文章を、具体例や背景情報を補足しながらより詳細に説明してください。\n\n# 元の文章:\n{text}",
    "translation": "以下の日本語の文章を自然な{lang}に翻訳してください。翻訳後の文章のみを出力。\n\n# 元の文章:\n{text}",
    "specialized_qa": """以下の文章から「{type_desc}」に焦点を当てたQAを1ペア生成。
出力はJSON形式: {{"question": "質問", "answer": "回答"}}

# 文章:
{context}""",
    "discussion": """以下の文章について専門家同士の議論を{turns}往復で生成してください。
形式: 質問者: (内容) / 回答者: (内容)

# 元の文章:
{text}""",
    "qa_difficult": """以下のテキストと専門用語情報を基に、専門的なQ&Aを生成してください。

【テキスト】
{text}

【関連する専門用語】
{terms_info}
""",
    "graph_relations": """以下の用語とその関係情報を、自然な日本語の文章（{max_chars}文字程度）にまとめてください。

用語: {node}
関係:
{relations_formatted}
""",
}
# What is asked about an HTML table and about a figure, and what stands for a figure that can't be described.
TABLE = """以下のHTML表を、自然な日本語の説明文に変換してください。

要件:
- 表の内容を正確に伝える
- 数値や項目名を省略しない
- 行や列の関係性を明確にする
- 箇条書きではなく、文章形式で記述する

HTML表:
{table}

説明文:"""
FIGURE = """この図について詳細に説明してください。

キャプション: {caption}

以下の情報を含めてください:
1. 図の種類（グラフ、チャート、図表、写真など）
2. 主要な要素や構成
3. 読み取れるデータや数値
4. 図が示す傾向や重要なポイント

簡潔かつ正確に説明してください。"""
NO_CAPTION, FIGURE_FAILED = "なし", "（図の分析に失敗しました）"
# What a specialised question asks about.
QA_FOCUS = {"methods": "手法・技術", "people": "人物名・組織名", "numbers": "数値・統計データ"}


def render(name: str, **values: Column | str) -> Column:
    """The user prompt with its variables filled in, as a column.

    An unknown name gives the empty string; a missing variable is an error.
    What is filled in is not looked at again, so braces in texts are safe.
    """
    template = USER.get(name, "")
    parts: list[Column] = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            if field not in values:
                raise ValueError(f"prompt '{name}' needs the variable '{field}'")
            value = values[field]
            parts.append(value.cast("string") if isinstance(value, Column) else F.lit(str(value)))
    return F.concat(*parts) if parts else F.lit("")


def qa_focus_prompt(context: Column, focus: str) -> Column:
    """The question prompt with one focus; an unknown focus is general."""
    return render("specialized_qa", context=context, type_desc=QA_FOCUS.get(focus, "一般"))


def difficult_qa_prompt(text: Column, terms: Column, most: int = 10) -> Column:
    """The expert-question prompt for the first ten ``struct(headword, brief_definition)`` and 2,000 characters; null without terms.

    Both bounds are the model's input limits and part of the prompt's definition.
    """
    shown = F.transform(F.slice(terms, 1, most), lambda t: F.concat(F.lit("- "), t["headword"], F.lit(": "), F.coalesce(t["brief_definition"], F.lit(""))))
    return F.when(F.size(terms) > 0, render("qa_difficult", text=F.substring(text, 1, 2000), terms_info=F.array_join(shown, "\n")))


def json_answer(answer: Column, schema: str, opening: str = "{", closing: str = "}") -> Column:
    """The JSON in an answer: inside a ```` ```json ```` fence if there is one, else the whole answer."""
    fenced = F.regexp_extract(answer, rf"(?s)```json\s*(\{opening}.*?\{closing})\s*```", 1)
    return F.from_json(F.when(fenced != "", fenced).otherwise(answer), schema)


def qa_text(question: Column, answer: Column, line_ends: int = 1) -> Column:
    """A pair as text; null unless both are there."""
    return F.concat(F.lit("質問: "), question, F.lit("\n" * line_ends + "回答: "), answer)
