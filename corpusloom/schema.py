"""Record types shared by the readers, the operators and the sinks."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(**fields: T.DataType) -> T.StructType:
    """A struct of nullable fields, in the order given."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STRING, INT, LONG, DOUBLE, BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

CHUNK_META = struct(source_file=STRING, chunk_id=INT, section_path=STRING, page_start=INT, page_end=INT, hierarchical_level=INT)
CHUNK = struct(id=STRING, text=STRING, meta=CHUNK_META)
BLOCK = struct(text=STRING, bbox=struct(x0=DOUBLE, y0=DOUBLE, x1=DOUBLE, y1=DOUBLE), block_type=STRING, font_size=DOUBLE, is_bold=BOOL, page_num=INT, column=INT)
CLEAN_STATS = struct(original_chars=INT, cleaned_chars=INT, removed_lines=INT, reduction_rate=DOUBLE)
CLEAN_RESULT = struct(text=STRING, removed_lines=T.ArrayType(STRING), stats=CLEAN_STATS)
TERM = struct(headword=STRING, brief_definition=STRING, definition=STRING, synonyms=T.ArrayType(STRING), domain=STRING, confidence=DOUBLE)
TERM_DICTIONARY = struct(terms=T.ArrayType(TERM))
EDGE = struct(type=STRING, source=STRING, target=STRING, key=INT)
GRAPH = struct(graph=struct(directed=BOOL, multigraph=BOOL, nodes=T.ArrayType(struct(id=STRING)), edges=T.ArrayType(EDGE)))
RELATIONS = T.ArrayType(struct(rel_type=STRING, targets=T.ArrayType(STRING)))
INSTRUCTION = struct(instruction=STRING, input=STRING, output=STRING)
QA_PAIR = struct(question=STRING, answer=STRING)
TABLE_CELL = struct(row_index=INT, column_index=INT, content=STRING, row_span=INT, column_span=INT)
LAYOUT_TABLE = struct(row_count=INT, column_count=INT, cells=T.ArrayType(TABLE_CELL))
GRID = T.ArrayType(T.ArrayType(STRING))
EXTRACTED = struct(texts=T.ArrayType(STRING), images=T.ArrayType(STRING), tables=T.ArrayType(GRID))

#: Every field that any step may put on an output record; absent ones stay null and are left out by the JSON sink.
OUTPUT_RECORD = struct(
    text=STRING, id=STRING, source=STRING, augmentation_type=STRING, source_id=STRING,
    question=STRING, answer=STRING, related_terms=T.ArrayType(STRING),
    node=STRING, relations=RELATIONS, relation_count=INT, keyword_count=INT,
    elaborations=T.ArrayType(struct(term=STRING, headword=STRING, explanation=STRING)),
    replacements=T.ArrayType(struct(original=STRING, replaced=STRING, headword=STRING)),
)
