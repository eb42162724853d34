"""The same queries as plain SQL on the test tables, for comparison."""

from __future__ import annotations

# Lines of each document with their place in the generated law. In document order: the main
# provision is element 1, article a is element 2 + 21 a, its paragraph n is 2n - 1 later and
# the sentence follows its paragraph.
_LINES = """
split AS (SELECT doc_id, source, 'doc-' || doc_id AS law_name,
                 string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, source, law_name, i, i // 10 AS a, i % 10 + 1 AS n, parts[i + 1] AS line
          FROM (SELECT *, unnest(range(len(parts))) AS i FROM split)),
placed AS (SELECT *, 2 + 21 * a AS a_ord, 1 + 21 * a + 2 * n AS p_ord,
                  CASE WHEN a % 3 = 2 THEN a || '_2' ELSE (a + 1)::VARCHAR END AS a_num,
                  CASE WHEN a % 3 = 2 THEN '第' || a || '条の2' ELSE '第' || (a + 1) || '条' END AS a_label,
                  CAST(CASE WHEN a % 3 = 2 THEN a + 0.002 ELSE a + 1 END AS DECIMAL(38,18)) AS a_value,
                  (doc_id % 3 < 2) AS reiki,
                  CAST((CAST(substr(source, 4) AS INTEGER) + 1) * 10000 + doc_id % 7 AS INTEGER) AS muni_id
           FROM lines),
ord_lines AS (SELECT * FROM placed WHERE reiki),
articles AS (SELECT DISTINCT doc_id, law_name, reiki, muni_id, a, a_ord, a_num, a_label, a_value FROM placed),
laws AS (SELECT doc_id, 'doc-' || doc_id AS law_name, (doc_id % 3 < 2) AS reiki,
                '第' || doc_id || ['号条例', '号規則', '号告示'][doc_id % 3 + 1] AS num,
                CAST((CAST(substr(source, 4) AS INTEGER) + 1) * 10000 + doc_id % 7 AS INTEGER) AS muni_id,
                CAST(CAST(substr(source, 4) AS INTEGER) + 1 AS SMALLINT) AS pref_id
         FROM documents),
sizes AS (SELECT doc_id, law_name, CAST(count(*) AS INTEGER) AS n_lines,
                 CAST(max(a) + 1 AS INTEGER) AS n_articles FROM placed GROUP BY ALL),
last AS (SELECT *, CAST(1 + n_articles + 2 * n_lines AS INTEGER) AS last_ord FROM sizes),
all_elems AS (
  SELECT doc_id, law_name, reiki, muni_id, 'MainProvision' AS etype, 1 AS ord, law_name || '(本則)' AS label,
         1 AS depth, 0 AS parent_ord FROM laws
  UNION ALL SELECT doc_id, law_name, reiki, muni_id, 'Article', a_ord, law_name || '(本則)' || a_label, 2, 1 FROM articles
  UNION ALL SELECT doc_id, law_name, reiki, muni_id, 'Paragraph', p_ord,
         law_name || '(本則)' || a_label || '第' || n || '項', 3, a_ord FROM placed
  UNION ALL SELECT doc_id, law_name, reiki, muni_id, 'ParagraphSentence', p_ord + 1,
         law_name || '(本則)' || a_label || '第' || n || '項第0文', 4, p_ord FROM placed),
elems AS (SELECT * FROM all_elems WHERE reiki),
munis AS (SELECT CAST((n_regionkey + 1) * 10000 + n_nationkey AS INTEGER) AS muni_id,
                 CAST(n_regionkey + 1 AS SMALLINT) AS pref_id, n_name AS muni_name, r_name AS pref_name
          FROM nation JOIN region ON n_regionkey = r_regionkey),
places AS (SELECT CAST((n_nationkey + 1) * 10000 + k AS INTEGER) AS muni_id, CAST(n_nationkey + 1 AS SMALLINT) AS pref_id,
                  n_name || '-' || k AS muni_name FROM (SELECT *, unnest(range(7)) AS k FROM nation))
"""


def _sql(body: str) -> str:
    return f"WITH {_LINES} {body}"


_TOKEN = r"\p{Han}+|\p{Hiragana}+|[\p{Katakana}ー]+|\p{Latin}+|\p{Nd}+"

_TYPES = (
    "MainProvision", "Part", "Chapter", "Section", "Subsection", "Division", "Article", "Paragraph",
    "Item", "Subitem1", "Subitem2", "Subitem3", "Subitem4", "Subitem5", "ArticleCaption",
    "ParagraphSentence", "ItemSentence",
)

ORACLES: dict[str, str] = {
    "count_elems": _sql(
        "SELECT t.etype, CAST(count(e.ord) AS BIGINT) AS n FROM (SELECT unnest(["
        + ", ".join(f"'{t}'" for t in _TYPES)
        + "]) AS etype) t LEFT JOIN elems e ON e.etype = t.etype GROUP BY t.etype"
    ),
    "count_elems_by_law": _sql("SELECT law_name, etype, count(*) AS n FROM elems GROUP BY ALL"),
    "count_rollup": _sql(
        "SELECT CAST(muni_id // 10000 AS SMALLINT) AS pref_id, muni_id, etype, count(*) AS n "
        "FROM elems GROUP BY ROLLUP (muni_id // 10000, muni_id, etype)"
    ),
    "sentences": _sql(
        "SELECT law_name, CAST(p_ord + 1 AS INTEGER) AS ord, 0 AS sentence_num, line AS sentence FROM ord_lines"
    ),
    "caption_sentences": _sql(
        # Each article has one more element, its caption.
        "SELECT law_name, CAST(p_ord + a + 2 AS INTEGER) AS ord, 'ParagraphSentence' AS etype, line AS sentence "
        "FROM ord_lines UNION ALL SELECT law_name, CAST(a_ord + a + 1 AS INTEGER), 'ArticleCaption', 'caption' "
        "FROM articles WHERE reiki"
    ),
    "plaintext": "SELECT 'doc-' || doc_id AS law_name, replace(text, chr(10), '') AS plaintext "
                 "FROM documents WHERE doc_id % 3 < 2",
    "plaintext_shared_numbers": _sql(
        "SELECT printf('%02d/%06d/%04d', l.pref_id, l.muni_id, l.doc_id) AS code, "
        "replace(coalesce(d.text, ''), chr(10), '') AS plaintext FROM laws l JOIN documents d USING (doc_id)"
    ),
    "leaves_pruned": _sql(
        "SELECT law_name, CAST(p_ord AS INTEGER) AS ord, 'Paragraph' AS etype FROM ord_lines"
    ),
    "leaves": _sql(
        "SELECT law_name, CAST(ord AS INTEGER) AS ord, etype FROM elems WHERE etype = 'ParagraphSentence'"
    ),
    "children": _sql("SELECT law_name, a_num AS article, CAST(n AS BIGINT) AS paragraph FROM ord_lines"),
    "children_of_provisions": _sql(
        "SELECT law_name, CAST(a_ord AS INTEGER) AS ord, 'Article' AS etype, a_value AS num FROM articles WHERE reiki"
    ),
    "descendants": _sql(
        "SELECT law_name, CAST(a_ord AS INTEGER) AS article_ord, CAST(2 * count(*) AS BIGINT) AS n "
        "FROM ord_lines GROUP BY law_name, a_ord"
    ),
    "descendants_of_all": _sql(
        # What is below: of a provision everything, of an article its 20 places, of a paragraph its sentence.
        "SELECT a.law_name, CAST(a.ord AS INTEGER) AS anc_ord, e.etype, count(*) AS n, "
        "CAST(min(e.ord) AS INTEGER) AS first_ord, CAST(max(e.ord) AS INTEGER) AS last_ord "
        "FROM elems a JOIN elems e ON e.doc_id = a.doc_id AND e.depth > a.depth AND CASE a.etype "
        "WHEN 'MainProvision' THEN true WHEN 'Article' THEN e.ord > a.ord AND e.ord <= a.ord + 20 "
        "ELSE e.parent_ord = a.ord END GROUP BY ALL"
    ),
    "adjacency_tree": _sql(
        "SELECT law_name, CAST(ord AS INTEGER) AS ord, CAST(depth AS INTEGER) AS depth, "
        "CAST(parent_ord AS INTEGER) AS parent_ord FROM elems"
    ),
    "citation_labels": _sql("SELECT law_name, CAST(ord AS INTEGER) AS ord, label FROM elems"),
    "element_lookup": _sql("SELECT law_name, 2 AS ord FROM laws WHERE reiki"),
    "etype_prune": _sql(
        "SELECT etype, count(*) AS n_all, count_if(NOT suppl)::BIGINT AS n_basic FROM ("
        "SELECT etype, false AS suppl FROM all_elems UNION ALL "
        "SELECT unnest(['SupplProvision', 'Paragraph', 'ParagraphSentence']), true FROM documents "
        "WHERE doc_id % 5 = 0) GROUP BY etype"
    ),
    "subitem_sentences": (
        "SELECT CASE WHEN k = 0 THEN 'ItemSentence' ELSE 'Subitem' || k || 'Sentence' END AS etype, "
        "CAST(4 + k AS INTEGER) AS depth, 'text' || k AS sentence, count(*) AS n "
        "FROM (SELECT unnest(range(6)) AS k FROM documents WHERE doc_id % 4 = 0) GROUP BY k"
    ),
    "law_numbers": _sql(
        "SELECT law_name AS name, '第' || translate(doc_id::VARCHAR, '0123456789', '〇一二三四五六七八九') "
        "|| ['号条例', '号規則', '号告示'][doc_id % 3 + 1] AS num_raw, num, law_name || ' (' || num || ')' AS label FROM laws"
    ),
    "law_codes": _sql(
        "SELECT pref_id, muni_id, CAST(doc_id AS INTEGER) AS file_id, "
        "printf('%02d/%06d/%04d', pref_id, muni_id, doc_id) AS code FROM laws"
    ),
    "is_reiki": _sql("SELECT law_name AS name, reiki AS is_reiki FROM laws"),
    "element_number": _sql(
        "SELECT law_name, CAST(a_ord AS INTEGER) AS ord, a_value AS num FROM articles WHERE reiki"
    ),
    "kanji_numerals": (
        "SELECT '第' || v || '号' AS plain, '第' || format('{:,}', v) || '号' AS separated FROM "
        "(SELECT CAST((l_orderkey % 9973) * 1000000007 + l_partkey AS BIGINT) AS v FROM lineitem)"
    ),
    "tokens": _sql(
        f"SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(line, '{_TOKEN}')) AS token "
        "FROM ord_lines) GROUP BY token"
    ),
    "chars": _sql(
        "SELECT char, count(*) AS n FROM (SELECT unnest(regexp_extract_all(line, '(?s).')) AS char "
        "FROM ord_lines) GROUP BY char"
    ),
    "segmented_sentences": _sql(
        "SELECT law_name, CAST(p_ord + 1 AS INTEGER) AS ord, "
        f"array_to_string(regexp_extract_all(line, '{_TOKEN}'), ' ') AS sentence FROM ord_lines"
    ),
    "string_dictionary": _sql(
        "SELECT DISTINCT line AS string FROM ord_lines WHERE line NOT IN "
        "(SELECT line FROM ord_lines WHERE doc_id % 6 = 0)"
    ),
    "string_edges": _sql(
        "SELECT law_name, CAST(p_ord + 1 AS INTEGER) AS ord, 0 AS sentence_num, line AS string FROM ord_lines"
    ),
    "register_laws": _sql(
        "SELECT muni_id, num AS law_num, CAST(doc_id AS INTEGER) AS file_id FROM laws WHERE reiki AND doc_id % 2 = 1"
    ),
    "quarantine": (
        "SELECT count(*) AS files, "
        "count_if(doc_id % 19 <> 0 AND doc_id % 3 < 2 AND doc_id % 23 <> 0)::BIGINT AS registered, "
        "0::BIGINT AS skipped_known, "
        "count_if(doc_id % 19 <> 0 AND doc_id % 3 = 2)::BIGINT AS skipped_not_reiki, "
        "count_if(doc_id % 19 = 0 OR (doc_id % 3 < 2 AND doc_id % 23 = 0))::BIGINT AS error FROM documents"
    ),
    "quarantine_files": (
        "SELECT CAST(doc_id AS INTEGER) AS file_id, CASE WHEN doc_id % 19 = 0 THEN 'error' WHEN doc_id % 3 = 2 THEN 'skipped_not_reiki' "
        "WHEN doc_id % 23 = 0 THEN 'error' ELSE 'registered' END AS outcome, "
        "CASE WHEN doc_id % 19 = 0 OR (doc_id % 3 < 2 AND doc_id % 23 = 0) THEN 1 ELSE 0 END::BIGINT AS n_errors, "
        "CASE WHEN doc_id % 19 = 0 THEN 'XMLStructureError' WHEN doc_id % 3 < 2 AND doc_id % 23 = 0 THEN 'HieralchyError' END AS error_class "
        "FROM documents"
    ),
    "incremental_outcomes": (
        "SELECT count(*) AS files, count_if(doc_id % 3 < 2 AND doc_id % 2 = 1)::BIGINT AS registered, "
        "count_if(doc_id % 3 < 2 AND doc_id % 2 = 0)::BIGINT AS skipped_known, "
        "count_if(doc_id % 3 = 2)::BIGINT AS skipped_not_reiki, 0::BIGINT AS error FROM documents"
    ),
    "stream_outcomes": (
        "SELECT count(*) AS files, count_if(doc_id % 3 < 2)::BIGINT AS registered, "
        "0::BIGINT AS skipped_known, count_if(doc_id % 3 = 2)::BIGINT AS skipped_not_reiki, "
        "0::BIGINT AS error FROM documents"
    ),
    "read_back": _sql(
        "SELECT l.muni_id, m.pref_id, CAST(l.doc_id AS INTEGER) AS file_id, l.law_name AS name, l.num, "
        "CAST(e.ord AS INTEGER) AS ord, e.etype, "
        "CASE e.etype WHEN 'Article' THEN a.a_value WHEN 'Paragraph' THEN p.n ELSE 0 END::DECIMAL(38,18) AS elem_num, "
        "coalesce(s.line, '') AS content FROM laws l JOIN places m USING (muni_id) JOIN elems e USING (doc_id) "
        "LEFT JOIN articles a ON a.doc_id = e.doc_id AND a.a_ord = e.ord "
        "LEFT JOIN placed p ON p.doc_id = e.doc_id AND p.p_ord = e.ord "
        "LEFT JOIN placed s ON s.doc_id = e.doc_id AND s.p_ord + 1 = e.ord"
    ),
    "dims_prefectures": _sql(
        "SELECT DISTINCT pref_id, pref_name AS name FROM munis"
    ),
    "dims_municipalities": _sql("SELECT muni_id, pref_id, muni_name AS name FROM munis"),
    "dims_join": _sql(
        "SELECT l.law_name AS name, l.num, l.muni_id, m.muni_name, m.pref_id "
        "FROM laws l JOIN places m ON m.muni_id = l.muni_id WHERE l.reiki"
    ),
    "unknown_municipalities": _sql(
        "SELECT DISTINCT muni_id FROM laws WHERE muni_id NOT IN (SELECT muni_id FROM munis)"
    ),
    "validate_grammar": _sql(
        "SELECT law_name, 'HieralchyError' AS error_class, "
        "CASE WHEN doc_id % 10 = 0 THEN 'invalid hieralchy Part -> Item' "
        "ELSE 'invalid hieralchy Article -> MainProvision' END AS error_detail, "
        "CAST(last_ord + 2 AS INTEGER) AS ord FROM last WHERE doc_id % 5 = 0"
    ),
    "validate_duplicates": _sql(
        "SELECT law_name, 'DuplicateNumberError' AS error_class, "
        "'element number duplication: ' || label AS error_detail, CAST(min(ord) AS INTEGER) AS ord FROM ("
        "SELECT law_name, a_label AS label, a_ord AS ord FROM articles UNION ALL "
        "SELECT law_name, '第1条', last_ord + 1 FROM last WHERE doc_id % 11 = 0) "
        "GROUP BY law_name, label HAVING count(*) > 1"
    ),
    "validate_num_format": _sql(
        "SELECT law_name, 'LawElementNumberError' AS error_class, 'Invalid Format 1-2' AS error_detail, "
        "CAST(p_ord AS INTEGER) AS ord, "
        "'## LawElementNumberError ##' || chr(10) || 'LawName: ' || chr(9) || p.law_name || chr(10) || "
        "'LawNum:  ' || chr(9) || l.num || chr(10) || 'Code:    ' || chr(9) || "
        "printf('%02d/%06d/%04d', l.pref_id, l.muni_id, l.doc_id) || chr(10) || 'Invalid Format 1-2' || "
        "chr(10) || chr(10) || chr(10) AS report "
        "FROM placed p JOIN laws l USING (doc_id, law_name) WHERE p.doc_id % 13 = 0 AND p.n = 3"
    ),
    "validate_siblings": _sql(
        "SELECT law_name, 'HieralchyError' AS error_class, "
        "'different type elements in the same layer: ' || CASE WHEN doc_id % 17 = 0 "
        "THEN 'Chapter and Article' ELSE 'Article and Chapter' END AS error_detail, "
        "CAST(CASE WHEN doc_id % 17 = 0 THEN last_ord + 1 ELSE 3 END AS INTEGER) AS ord "
        "FROM last WHERE doc_id % 17 IN (0, 5)"
    ),
    "validate_lengths": _sql(
        "SELECT printf('%02d/%06d/%04d', pref_id, muni_id, doc_id) AS code, 'LengthError' AS error_class, "
        "'law_name has ' || (500 + length(law_name)) || ' characters' AS error_detail FROM laws WHERE doc_id % 29 = 0"
    ),
    "first_errors": _sql(
        "SELECT law_name, 'HieralchyError' AS error_class, "
        "'invalid hieralchy MainProvision -> Division' AS error_detail, CAST(last_ord + 1 AS INTEGER) AS ord "
        "FROM last WHERE doc_id % 3 = 0"
    ),
    "adjacency_tree_orphans": _sql(
        # Laws 3 mod 7 lose their article 1 (ord 2) and what is below it is orphaned; in laws 4 mod 7 the first
        # paragraph (ord 3) and its sentence point at each other.
        "SELECT law_name, CAST(ord AS INTEGER) AS ord, "
        "CASE WHEN lost THEN 'orphan' WHEN looped THEN 'cycle' ELSE 'rooted' END AS linkage, "
        "CASE WHEN lost OR looped THEN NULL ELSE CAST(depth AS INTEGER) END AS depth, "
        "CAST(CASE WHEN looped THEN 0 WHEN lost THEN depth - 3 ELSE depth - 1 END AS INTEGER) AS n_above FROM ("
        "SELECT *, doc_id % 7 = 3 AND ord BETWEEN 3 AND 22 AND depth > 2 AS lost, "
        "doc_id % 7 = 4 AND ord IN (3, 4) AS looped FROM elems WHERE NOT (doc_id % 7 = 3 AND ord = 2))"
    ),
    "file_outcomes": (
        "SELECT CAST(doc_id AS INTEGER) AS file_id, CASE WHEN doc_id % 2 = 0 THEN first END AS run0, "
        "CASE WHEN doc_id % 2 = 0 AND first = 'registered' THEN 'skipped_known' ELSE first END AS run1, "
        "CASE WHEN first = 'registered' THEN 'skipped_known' ELSE first END AS run2, "
        "1::BIGINT AS n_stored, first AS state FROM "
        "(SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN 'registered' ELSE 'skipped_not_reiki' END AS first FROM documents)"
    ),
    "stream_states": (
        "SELECT CAST(doc_id AS INTEGER) AS file_id, "
        "CASE WHEN doc_id % 3 < 2 THEN 'registered' ELSE 'skipped_not_reiki' END AS outcome FROM documents"
    ),
    # Three micro-batches: two and one.
    "stream_merged": _sql("SELECT law_name AS name, num, 2 AS batches FROM laws WHERE reiki"),
    "warehouse_tables": _sql(
        "SELECT 'laws' AS name, count(*) AS n FROM laws WHERE reiki UNION ALL SELECT 'elements', count(*) FROM elems "
        "UNION ALL SELECT 'strings', count(DISTINCT line) FROM ord_lines UNION ALL SELECT 'string_edges', count(*) FROM ord_lines "
        "UNION ALL SELECT 'errors', 0 UNION ALL SELECT 'outcomes', count(*) FROM documents "
        "UNION ALL SELECT 'prefectures', count(*) FROM nation UNION ALL SELECT 'municipalities', count(*) FROM places"
    ),
    "reset_tables": _sql(
        "SELECT state, count(*) FILTER (reiki AND state <> 'reset') AS laws FROM laws, "
        "(SELECT unnest(['before', 'reset', 'after']) AS state) GROUP BY state"
    ),
    "stored_names": _sql(
        "SELECT muni_id, CAST(doc_id AS INTEGER) AS file_id, law_name AS name, num FROM laws WHERE reiki"
    ),
    "stored_provisions": _sql(
        "SELECT law_name AS name, 0 AS place, 'MainProvision' AS etype, 0::DECIMAL(38,18) AS num, 1 AS ord FROM laws WHERE reiki "
        "UNION ALL SELECT law_name, 1, 'SupplProvision', 0, CAST(last_ord + 1 AS INTEGER) FROM last WHERE doc_id % 5 = 0 AND doc_id % 3 < 2"
    ),
    "stored_children": _sql(
        "SELECT name, CAST(parent_ord AS INTEGER) AS parent_ord, CAST(row_number() OVER (PARTITION BY name, parent_ord "
        "ORDER BY num, ord) - 1 AS INTEGER) AS place, etype, num, CAST(ord AS INTEGER) AS ord FROM ("
        "SELECT law_name AS name, 1 AS parent_ord, 'Article' AS etype, a_value AS num, a_ord AS ord FROM articles WHERE reiki "
        "UNION ALL SELECT law_name, a_ord, 'Paragraph', n, p_ord FROM ord_lines "
        "UNION ALL SELECT law_name, p_ord, 'ParagraphSentence', 0, p_ord + 1 FROM ord_lines)"
    ),
    "stored_contents": _sql(
        "SELECT law_name AS name, CAST(i AS INTEGER) AS place, line AS content FROM ord_lines"
    ),
    "one_law": _sql(
        ", chosen AS (SELECT * FROM laws WHERE reiki AND doc_id = (SELECT max(doc_id) FROM laws WHERE reiki)) "
        "SELECT 'header' AS part, concat_ws(' ', doc_id, muni_id, m.pref_id, law_name, num) AS value "
        "FROM chosen JOIN places m USING (muni_id) "
        "UNION ALL SELECT 'name', law_name || ' ' || num FROM chosen "
        "UNION ALL SELECT 'child', a_value::DECIMAL(20,3)::VARCHAR FROM articles WHERE doc_id IN (SELECT doc_id FROM chosen) "
        "UNION ALL SELECT 'content', line FROM placed WHERE i = 0 AND doc_id IN (SELECT doc_id FROM chosen)"
    ),
    "municipality_list": _sql(
        "SELECT CAST((n_nationkey + 1) * 10000 + k AS INTEGER) AS code, n_name AS pref_name, n_name || '-' || k AS muni_name "
        "FROM (SELECT *, unnest(range(7)) AS k FROM nation)"
    ),
    "validate_types": _sql(
        "SELECT law_name, 'HieralchyError' AS error_class, 'invalid hieralchy Article -> ItemSentence' AS error_detail, "
        "CAST(last_ord + 2 AS INTEGER) AS ord FROM last WHERE doc_id % 9 = 0 UNION ALL "
        "SELECT law_name, 'EtypeError', 'unknown type Subitem1Sentence', CAST(last_ord + 4 AS INTEGER) FROM last WHERE doc_id % 9 = 4"
    ),
    "validate_number_lengths": _sql(
        "SELECT printf('%02d/%06d/%04d', pref_id, muni_id, doc_id) AS code, 'LengthError' AS error_class, "
        "'law_num has ' || (500 + length(num)) || ' characters' AS error_detail FROM laws WHERE doc_id % 31 = 0"
    ),
    "unknown_names": _sql(
        "SELECT CAST(doc_id AS INTEGER) AS file_id, CASE WHEN doc_id % 4 = 0 THEN 'UNK' ELSE law_name END AS name, "
        "CASE WHEN doc_id % 6 = 0 THEN 'UNK' ELSE num END AS num, reiki AND doc_id % 6 <> 0 AS is_reiki FROM laws"
    ),
}
ORACLES["plaintext_of_elements"] = ORACLES["plaintext"]
