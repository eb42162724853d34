"""Element types, document grammar and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Element types in rank order with their labels.
ETYPE_LABELS = {
    "MainProvision": "本則",
    "SupplProvision": "附則",
    "Part": "編",
    "Chapter": "章",
    "Section": "節",
    "Subsection": "款",
    "Division": "目",
    "Article": "条",
    "Paragraph": "項",
    "Item": "号",
    "Subitem1": "号",
    "Subitem2": "号",
    "Subitem3": "号",
    "Subitem4": "号",
    "Subitem5": "号",
    "ArticleCaption": "条見出し",
    "ParagraphSentence": "文",
    "ItemSentence": "文",
}

# The element types a subitem's text may carry. They are outside the stored
# type list and are read only with ``include_subitem_sentences``.
SUBITEM_SENTENCES = tuple(f"Subitem{i}Sentence" for i in range(1, 6))

ETYPES = tuple(ETYPE_LABELS)
BASIC_ETYPES = tuple(e for e in ETYPES if e != "SupplProvision")
PROVISIONS = ("MainProvision", "SupplProvision")
TEXT_ETYPES = ("ArticleCaption", "ParagraphSentence", "ItemSentence") + SUBITEM_SENTENCES
# Types whose number is 0 whatever their Num attribute says.
UNNUMBERED_ETYPES = PROVISIONS + ("ArticleCaption",)

ETYPE_RANK = {e: i for i, e in enumerate(ETYPES + SUBITEM_SENTENCES)}
LABELS = {**ETYPE_LABELS, **{e: "文" for e in SUBITEM_SENTENCES}}

ROOT = "Root"

_ITEMS = ("Item", "Subitem1", "Subitem2", "Subitem3", "Subitem4", "Subitem5")

# Allowed parents per element type. Every subitem counts as an item, so
# whatever may sit under Item may sit under Subitem1..5 too.
GRAMMAR = {
    "MainProvision": (ROOT,),
    "SupplProvision": (ROOT,),
    "Part": ("MainProvision",),
    "Chapter": ("MainProvision", "Part"),
    "Section": ("Chapter",),
    "Subsection": ("Section",),
    "Division": ("Subsection",),
    "Article": (
        "MainProvision", "SupplProvision", "Part", "Chapter", "Section", "Subsection", "Division",
    ),
    "ArticleCaption": ("Article",),
    "Paragraph": ("MainProvision", "SupplProvision", "Article"),
    "ParagraphSentence": ("Paragraph",),
    "Item": ("Article", "Paragraph"),
    "ItemSentence": _ITEMS,
    "Subitem1": _ITEMS,
    "Subitem2": ("Subitem1",),
    "Subitem3": ("Subitem2",),
    "Subitem4": ("Subitem3",),
    "Subitem5": ("Subitem4",),
    # One level up is the declared grammar, the like-numbered subitem is where files put it.
    "Subitem1Sentence": _ITEMS,
    "Subitem2Sentence": ("Subitem1", "Subitem2"),
    "Subitem3Sentence": ("Subitem2", "Subitem3"),
    "Subitem4Sentence": ("Subitem3", "Subitem4"),
    "Subitem5Sentence": ("Subitem4", "Subitem5"),
}

NAME_LIMIT = 50  # prefecture and municipality names
LAW_LIMIT = 500  # law names and numbers

NUM = T.DecimalType(38, 18)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


FILES = _struct(
    ("path", T.StringType()),
    ("modification_time", T.TimestampType()),
    ("length", T.LongType()),
    ("pref_id", T.ShortType()),
    ("muni_id", T.IntegerType()),
    ("file_id", T.IntegerType()),
    ("code", T.StringType()),
    ("content", T.BinaryType()),
)

# One entry per ancestor, outermost first; the last one is the parent.
LINEAGE = T.ArrayType(
    _struct(("ord", T.IntegerType()), ("etype", T.StringType()), ("num_raw", T.StringType()))
)

NODE = _struct(
    ("ord", T.IntegerType()),
    ("end_ord", T.IntegerType()),
    ("depth", T.IntegerType()),
    ("etype", T.StringType()),
    ("num_raw", T.StringType()),
    ("texts", T.ArrayType(T.StringType())),
    ("lineage", LINEAGE),
)

LAWS = _struct(
    ("law_id", T.LongType()),
    ("pref_id", T.ShortType()),
    ("muni_id", T.IntegerType()),
    ("file_id", T.IntegerType()),
    ("code", T.StringType()),
    ("name", T.StringType()),
    ("num", T.StringType()),
    ("num_raw", T.StringType()),
    ("is_reiki", T.BooleanType()),
)

ELEMENTS = _struct(
    ("law_id", T.LongType()),
    ("elem_id", T.LongType()),
    ("parent_id", T.LongType()),
    ("etype", T.StringType()),
    ("etype_rank", T.IntegerType()),
    ("num", NUM),
    ("num_path", T.ArrayType(T.LongType())),
    ("num_raw", T.StringType()),
    ("texts", T.ArrayType(T.StringType())),
    ("ord", T.IntegerType()),
    ("end_ord", T.IntegerType()),
    ("depth", T.IntegerType()),
    ("lineage", LINEAGE),
)

PREFECTURES = _struct(("pref_id", T.ShortType()), ("name", T.StringType()))

MUNICIPALITIES = _struct(
    ("muni_id", T.IntegerType()), ("pref_id", T.ShortType()), ("name", T.StringType())
)

STRINGS = _struct(("string_id", T.StringType()), ("string", T.StringType()))

STRING_EDGES = _struct(
    ("law_id", T.LongType()),
    ("elem_id", T.LongType()),
    ("sentence_num", T.IntegerType()),
    ("string_id", T.StringType()),
)

ERRORS = _struct(
    ("path", T.StringType()),
    ("code", T.StringType()),
    ("law_name", T.StringType()),
    ("law_num", T.StringType()),
    ("error_class", T.StringType()),
    ("error_detail", T.StringType()),
    ("ord", T.IntegerType()),
)

OUTCOMES = _struct(
    ("path", T.StringType()),
    ("modification_time", T.TimestampType()),
    ("length", T.LongType()),
    ("code", T.StringType()),
    ("outcome", T.StringType()),
    # How law numbers were read, and when.
    ("reading", T.StringType()),
    ("decided_at", T.TimestampType()),
)

# One row per batch: the tables it wrote, and the batches that it stands for.
MANIFEST = _struct(
    ("batch_id", T.StringType()),
    ("tables", T.ArrayType(T.StringType())),
    ("committed_at", T.TimestampType()),
    ("replaces", T.ArrayType(T.StringType())),
)
