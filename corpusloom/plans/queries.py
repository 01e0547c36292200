"""The registered queries of the core operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import chunking, clean, prompts, rx
from corpusloom.operators import dedup, generate, layout, lexicon, merge, pack, quality, relations
from corpusloom.plans import pipeline
from corpusloom.sources.tables import latest, table

Query = Callable[[SparkSession, str], DataFrame]


def _t() -> Column:
    return F.col("text")


def chunks(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Delivered chunks: line number, text and what else is asked for."""
    return table(spark, d, "chunks").select("line_no", *columns, "text")


def terms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "terms").fillna({"confidence": 1.0})


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Documents, characters and estimated tokens by language after cleaning, safety and exact deduplication."""
    df = rx.once(table(spark, d, "documents", "doc_id", "lang", "text"), "text", clean.normalize_whitespace(clean.normalize_numbers(_t())))
    df = df.where(quality.is_safe(_t())).select("doc_id", "lang", F.md5("text").alias("k"), F.length("text").alias("chars"), pack.estimate_tokens(_t()).alias("tokens"))
    df = dedup.first_of_equal(df, F.col("k"), "doc_id")  # no text travels
    return df.groupBy("lang").agg(F.count("*").alias("docs"), F.sum("chars").alias("chars"), F.sum("tokens").alias("est_tokens"))


def _text(f: Callable[[Column], Column]) -> Query:
    return lambda spark, d: chunks(spark, d).select("line_no", f(_t()).alias("text"))


def _base(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "chunks").select("id", "line_no", "loaded_at", "text"), "id").where(_t().isNotNull()).select(F.col("line_no").alias("pos"), "id", "text")


def latest_chunks(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "chunks").select("id", "line_no", "loaded_at", "text"), "id").select("id", "line_no", "text")


def cleaner(spark: SparkSession, d: str) -> DataFrame:
    rows = clean.clean_rows(chunks(spark, d))
    return rows.select("line_no", "cleaned.text", "cleaned.removed_lines", "cleaned.stats.reduction_rate")


def page_lines(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).select("line_no", clean.drop_page_numbers(_t()).alias("text"), rx.unlines(clean.page_number_lines(_t())).alias("removed"))


def page_span(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).select("line_no", clean.page_span(_t()).alias("s")).select("line_no", "s.*")


def frequent_edges(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "chunks").select("meta.source_file", "line_no", "text")
    return layout.drop_frequent_edges(pages, "source_file", "line_no")


def toc(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text").withColumn("s", clean.split_toc(_t()))
    return docs.select("doc_id", "s.text", F.size("s.removed").alias("removed"))


def figures(spark: SparkSession, d: str) -> DataFrame:
    said = F.array(F.struct(F.lit("図").alias("caption"), F.lit("説明").alias("description")))
    return chunks(spark, d).select("line_no", clean.substitute_figures(_t(), said).alias("text"))


def tables_in(spark: SparkSession, d: str) -> DataFrame:
    tables = F.array(F.struct(F.lit(1).alias("page"), F.lit(1).alias("number"), F.lit("| a |").alias("markdown")))
    return chunks(spark, d).select("line_no", clean.inject_tables(_t(), tables).alias("text"))


def pages_joined(spark: SparkSession, d: str) -> DataFrame:
    parts = F.split(_t(), "\n\n", -1)
    return chunks(spark, d).select("line_no", clean.join_pages(parts).alias("text"))


def _cells(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    row = F.col("l_linenumber").cast("int") - 1
    cell = lambda c, span, x: F.struct(row.alias("row_index"), F.lit(c).alias("column_index"), F.col(x).alias("content"), F.lit(1).alias("row_span"), F.lit(span).alias("column_span"))
    one = F.array(cell(0, 2, "l_returnflag"), cell(2, 1, "l_linestatus"))
    per = items.groupBy("l_orderkey").agg(F.max(F.col("l_linenumber").cast("int")).alias("rows"), F.flatten(F.array_sort(F.collect_list(one))).alias("cells"))
    return per.select("l_orderkey", layout.grid(F.col("rows"), F.lit(3), F.col("cells")).alias("grid"))


def grids(spark: SparkSession, d: str) -> DataFrame:
    return _cells(spark, d).select("l_orderkey", layout.grid_markdown(F.col("grid")).alias("markdown"))


def combined(spark: SparkSession, d: str) -> DataFrame:
    one = F.array(F.array(F.array("title", "short_title"), F.array(F.col("pub_year").cast("string"), F.col("n_pages").cast("string"))))
    return table(spark, d, "source_files").select("source_file", layout.combine_elements(F.array("title"), one).alias("text"))


def two_columns(spark: SparkSession, d: str) -> DataFrame:
    blocks = table(spark, d, "events").select((F.col("user_id") % 50).alias("page"), (F.col("value") * 7 % 500).alias("x0"), (F.col("value") * 7 % 500 + 60).alias("x1"), F.lit(560.0).alias("width"))
    return layout.is_two_column(blocks, "page", "x0", "x1", "width")


def sentences(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).select("line_no", clean.is_complete_sentence(_t()).alias("complete"), clean.is_complete_sentence(_t(), 50).alias("no_fragment"))


def safe(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text").where(quality.is_safe(_t())).select("doc_id")


def exact_first(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_of_equal(table(spark, d, "documents", "doc_id", "text").withColumn("k", F.md5("text")).drop("text"), F.col("k"), "doc_id").select("doc_id")


def near_pairs(spark: SparkSession, d: str) -> DataFrame:
    classes = dedup.word_classes(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text")
    return dedup.similar_classes(classes).select("a", "b")


def near_first(spark: SparkSession, d: str) -> DataFrame:
    return dedup.near_duplicates(table(spark, d, "documents", "doc_id", "text"), "doc_id")


def perplexity(spark: SparkSession, d: str) -> DataFrame:
    scorer = quality.trigram_scorer(["図に示すように、値は単調に増加する。装置の寿命を測定した。", "The signal was sampled and filtered."])
    return quality.filter_perplexity(table(spark, d, "documents", "doc_id", "text"), scorer).select("doc_id")


def chunked(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text").select(F.concat("doc_id", F.lit(".pdf")).alias("source_file"), "text")
    return chunking.chunk_documents(docs).select("source_file", "id", "text", "meta.section_path", "meta.page_start", "meta.hierarchical_level", "error")


def surfaces(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.surfaces(terms(spark, d)).select("surface", F.col("ord.pos").alias("first_pos"), F.col("entry.pos").alias("entry_pos"), F.col("entry.headword").alias("headword"))


def _definitions(form: str) -> Query:
    return lambda spark, d: lexicon.definition_texts(terms(spark, d), form).select("pos", "text")


def patterns(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.pattern_texts(terms(spark, d)).select("pos", "n", "text")


def found_terms(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.find_terms(chunks(spark, d), terms(spark, d), "line_no").select("line_no", F.col("entry.headword").alias("headword"), "rank")


def keywords(spark: SparkSession, d: str) -> DataFrame:
    words = lexicon.extract_keywords(chunks(spark, d), terms(spark, d), "line_no")
    return words.select("line_no", "keyword_count", F.array_join(F.transform("keywords", lambda k: k["term"]), "|").alias("terms"))


def keyword_texts(spark: SparkSession, d: str) -> DataFrame:
    words = lexicon.extract_keywords(chunks(spark, d), terms(spark, d), "line_no")
    return words.select("line_no", lexicon.render_keywords(F.col("keywords")).alias("text"))


def elaborated(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.elaborate(chunks(spark, d), terms(spark, d)).select("line_no", "text", F.size("elaborations").alias("n"))


def generalized(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.generalize(chunks(spark, d), terms(spark, d), changed_only=True).select("line_no", "text", F.size("replacements").alias("n"))


def edges(spark: SparkSession, d: str) -> DataFrame:
    return relations.distinct_edges(table(spark, d, "graph_edges"))


def nodes(spark: SparkSession, d: str) -> DataFrame:
    n = relations.node_relations(table(spark, d, "graph_edges"))
    return n.select("node", "pos", relations.format_relations(F.col("relations")).alias("relations"), "relation_count")


def first_nodes(spark: SparkSession, d: str) -> DataFrame:
    return relations.first_nodes(relations.node_relations(table(spark, d, "graph_edges")), 20).select("node", "pos")


def relation_texts(spark: SparkSession, d: str) -> DataFrame:
    return generate.relation_texts(table(spark, d, "graph_edges"), generate.measured).select("node", "text", "source", "relation_count")


def rendered(spark: SparkSession, d: str) -> DataFrame:
    return chunks(spark, d).where(_t().isNotNull()).select("line_no", prompts.render("summary", text=_t(), max_length="150").alias("summary"), prompts.qa_focus_prompt(_t(), "numbers").alias("focus"))


def json_answers(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("pair_id") % 2 == 0, F.concat(F.lit("答え:\n```json\n"), F.to_json(F.struct("question", "answer")), F.lit("\n```\n以上"))).otherwise(F.to_json(F.struct("question", "answer")))
    rows = table(spark, d, "qa_pairs", "line_no", "pair_id", "question", "answer").withColumn("p", prompts.json_answer(raw, "question string, answer string"))
    return rows.select("line_no", F.col("p.question").alias("question"), F.col("p.answer").alias("answer"))


def qa_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_pairs", "line_no", "question", "answer").select("line_no", prompts.qa_text(F.col("question"), F.col("answer")).alias("text"))


def english(spark: SparkSession, d: str) -> DataFrame:
    return generate.to_english(chunks(spark, d), generate.measured).select("line_no", "text", "source")


def _rewritten(name: str, **values: str) -> Query:
    return lambda spark, d: generate.rewrite(chunks(spark, d), name, generate.measured, **values).select("line_no", "text", "source")


def question_answers(spark: SparkSession, d: str) -> DataFrame:
    return generate.question_answers(chunks(spark, d), generate.measured_json).select("line_no", "question", "answer", "text", "source")


def focused(spark: SparkSession, d: str) -> DataFrame:
    parts = [generate.focused_questions(chunks(spark, d), focus, generate.measured_json).select("line_no", F.lit(focus).alias("focus"), "text") for focus in prompts.QA_FOCUS]
    return parts[0].union(parts[1]).union(parts[2])


def llm_keywords(spark: SparkSession, d: str) -> DataFrame:
    return generate.keyword_texts(chunks(spark, d), generate.measured_json).select("line_no", "text", "source")


def difficult(spark: SparkSession, d: str) -> DataFrame:
    """Expert questions of the chunks that hold terms, in the order the terms are found."""
    found = lexicon.find_terms(chunks(spark, d), terms(spark, d), "line_no").select("line_no", F.struct("rank", F.col("entry.headword").alias("headword"), F.col("entry.brief_definition").alias("brief_definition")).alias("t"))
    per = found.groupBy("line_no").agg(F.array_sort(F.collect_list("t")).alias("terms"))  # at most one entry per headword of the dictionary
    rows = chunks(spark, d).join(per, "line_no")
    return generate.difficult_questions(rows, generate.measured_json).select("line_no", "question", "answer", "text", "augmentation_type")


def html_tables(spark: SparkSession, d: str) -> DataFrame:
    return generate.describe_tables(chunks(spark, d), generate.measured).select("line_no", "text")


def conversations(spark: SparkSession, d: str) -> DataFrame:
    said = lambda i, role, x: F.struct(F.lit(i).alias("turn"), F.lit(role).alias("role"), F.col(x).alias("content"))
    rows = table(spark, d, "qa_pairs", "line_no", "question", "answer").select("line_no", F.inline(F.array(said(2, "assistant", "answer"), said(1, "user", "question"))))
    return merge.conversations(rows, "line_no", "turn", "role", "content")


def descriptions(spark: SparkSession, d: str) -> DataFrame:
    said = F.when(F.col("line_no") % 3 == 0, F.concat(F.lit("TEXT_ONLY: "), _t())).otherwise(F.concat(F.lit("これは図表ではありません。"), _t(), F.lit("\n\n\n\n図表ではありません。")))
    return chunks(spark, d).select("line_no", clean.tidy_description(said).alias("text"))


def augmented(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "qa_pairs", "line_no", "source_id", "answer").withColumn("log", F.col("line_no"))
    return lexicon.augmented(rows, "elaboration", "log", text="answer", id="source_id")


def packed(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunks").select("meta.source_file", "line_no", "text")
    return pack.pack(rows, "source_file", "line_no").select("source_file", "pack", "n", "tokens", F.length("text").alias("chars"))


def pack_stats(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunks").select("meta.source_file", "line_no", "text")
    return pack.pack_stats(rows, pack.pack(rows, "source_file", "line_no"))


def token_estimates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", pack.estimate_tokens(_t()).alias("pack_tokens"), pack.estimate_merged_tokens(F.length(_t())).alias("merge_tokens"))


def shuffled(spark: SparkSession, d: str) -> DataFrame:
    return pack.shuffled(table(spark, d, "documents", "doc_id", "lang"), "doc_id")


def chat(spark: SparkSession, d: str) -> DataFrame:
    context = F.array_join("related_terms", "、")
    return table(spark, d, "qa_pairs").select("line_no", merge.chat_text(F.col("question"), context, F.col("answer")).alias("text"))


def split(spark: SparkSession, d: str) -> DataFrame:
    return merge.train_eval(table(spark, d, "documents", "doc_id"), "doc_id").select("doc_id", "split")


def merged(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, "documents", "doc_id", "text", "source"), lexicon.pattern_texts(terms(spark, d)).select("text", "source"), table(spark, d, "chunks", "id", "text")]
    return merge.default_source(merge.union_in_order(parts)).groupBy("step_rank", "source").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


def merge_stats(spark: SparkSession, d: str) -> DataFrame:
    return merge.merge_stats(table(spark, d, "chunks", "text"))


def histogram(spark: SparkSession, d: str) -> DataFrame:
    return merge.source_histogram(table(spark, d, "documents", "source"))


def steps(spark: SparkSession, d: str) -> DataFrame:
    available = pipeline.steps(terms(spark, d), table(spark, d, "graph_edges"), generate.stand_in)
    out = pipeline.run(_base(spark, d), "all", available)
    return out.groupBy("step_rank", "source").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


def quality_rows(spark: SparkSession, d: str) -> DataFrame:
    scorer = quality.trigram_scorer(["図に示すように、値は単調に増加する。装置の寿命を測定した。", "The signal was sampled and filtered."])
    return pipeline.quality_rows(table(spark, d, "documents", "doc_id", "text"), "doc_id", scorer).select("doc_id")


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.cleaned(chunks(spark, d))


def cleaning_report(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.cleaning_report(chunks(spark, d))


def _qa(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "qa_pairs").select("line_no", "pair_id", "question", F.col("answer").alias("text"), "augmentation_type")


def view_type(spark: SparkSession, d: str) -> DataFrame:
    return merge.of_type(_qa(spark, d), "qa_difficult").select("line_no", "pair_id")


def view_search(spark: SparkSession, d: str) -> DataFrame:
    return merge.search(_qa(spark, d), "Bearing").select("line_no")


def view_metrics(spark: SparkSession, d: str) -> DataFrame:
    return merge.metrics(_qa(spark, d))


def view_head(spark: SparkSession, d: str) -> DataFrame:
    return merge.head(_qa(spark, d), "line_no").select("line_no", "pair_id")


def view_record(spark: SparkSession, d: str) -> DataFrame:
    return merge.record(_qa(spark, d), "line_no", 42).select("line_no", "pair_id")


def view_types(spark: SparkSession, d: str) -> DataFrame:
    return merge.types(_qa(spark, d), "line_no")


QUERIES: dict[str, Query] = {
    "flagship": flagship,
    "latest_chunks": latest_chunks,
    "c1_nfkc": _text(clean.nfkc),
    "c2_page_number_lines": page_lines,
    "c3_header_footer_lines": _text(clean.drop_headers_footers),
    "c4_frequent_edges": frequent_edges,
    "c5_toc": toc,
    "c6_line_repair": _text(clean.repair_lines),
    "c7_numbers": _text(clean.normalize_numbers),
    "c8_whitespace": _text(clean.normalize_whitespace),
    "c9_cleaner": cleaner,
    "c10_japanese": _text(clean.clean_japanese),
    "c11_layout_spaces": _text(clean.strip_layout_spaces),
    "c12_markdown": _text(clean.clean_markdown),
    "c13_blank_before_headings": _text(clean.blank_before_headings),
    "c14_headings": _text(clean.normalize_headings),
    "c15_complete_sentence": sentences,
    "c17_cleaned": cleaned,
    "c17_cleaning_report": cleaning_report,
    "c18_pages": page_span,
    "c19_figures": figures,
    "c22_tables": tables_in,
    "c24_grid": grids,
    "c25_combined": combined,
    "c26_two_columns": two_columns,
    "s8_pages_joined": pages_joined,
    "h3_chunked": chunked,
    "q1_safe": safe,
    "q2_near_pairs": near_pairs,
    "q2_near_first": near_first,
    "q3_exact_first": exact_first,
    "q4_perplexity": perplexity,
    "q5_quality_rows": quality_rows,
    "d1_definitions_all": _definitions("all"),
    "d1_definitions_qa": _definitions("qa"),
    "d2_surfaces": surfaces,
    "d3_elaborated": elaborated,
    "d4_generalized": generalized,
    "d5_keywords": keywords,
    "d6_keyword_texts": keyword_texts,
    "d7_found_terms": found_terms,
    "d8_patterns": patterns,
    "g2_edges": edges,
    "g4_nodes": nodes,
    "g6_first_nodes": first_nodes,
    "g7_relation_texts": relation_texts,
    "l1_paraphrased": _rewritten("paraphrase"),
    "l2_question_answers": question_answers,
    "l3_summaries": _rewritten("summary", max_length="150"),
    "l4_keywords": llm_keywords,
    "l5_elaborations": _rewritten("elaboration"),
    "l6_translations": _rewritten("translation", lang="英語"),
    "l7_focused": focused,
    "l8_discussions": _rewritten("discussion", turns="3"),
    "l9_difficult": difficult,
    "l14_descriptions": descriptions,
    "c20_html_tables": html_tables,
    "d9_augmented": augmented,
    "f3_conversations": conversations,
    "d1_definitions_simple": _definitions("simple"),
    "d1_definitions_definition": _definitions("definition"),
    "l2_qa_texts": qa_texts,
    "l10_english": english,
    "l12_rendered": rendered,
    "l13_json_answers": json_answers,
    "pk1_token_estimates": token_estimates,
    "pk3_packed": packed,
    "pk4_pack_stats": pack_stats,
    "pk5_shuffled": shuffled,
    "f1_chat": chat,
    "f4_split": split,
    "m1_merged": merged,
    "m2_merge_stats": merge_stats,
    "m3_histogram": histogram,
    "m5_steps": steps,
    "v1_type": view_type,
    "v2_search": view_search,
    "v3_metrics": view_metrics,
    "v4_head": view_head,
    "v5_record": view_record,
    "v6_types": view_types,
}
