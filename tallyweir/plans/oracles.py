"""The same queries as plain SQL over the given tables, for an independent check of every result.

Each oracle is a final SELECT over named table expressions; ``_sql`` puts the ones it needs in front.
"""

from __future__ import annotations

import re

_BUSINESS = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"

# White space as the operators see it, for a regular-expression engine whose \s is ASCII only.
_SPACE = (
    r"[\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '{_SPACE}+'), lambda t: t <> '')"


def _six(value: str) -> str:
    return f"floor(({value}) * 1e6 + 0.5) / 1e6"


def _nine(value: str) -> str:
    return f"floor(({value}) * 1e9 + 0.5) / 1e9"


_DATE = "try_strptime(regexp_replace(trim({0}), '\\s+', ' ', 'g'), '%m/%d/%Y %H:%M')"

_TABLES: dict[str, str] = {}

_TABLES["retail_lines"] = r"""
SELECT l_orderkey * 10 + l_linenumber AS line_id,
  CAST((l_orderkey * 31 + l_partkey * 7 + l_linenumber) % 97 AS INTEGER) AS defect,
  CASE WHEN l_returnflag = 'R' THEN 'C'
       WHEN l_orderkey >= 1000000 THEN chr(CAST(68 + (l_orderkey // 1000000) % 22 AS INTEGER)) ELSE '' END
    || printf('%06d', l_orderkey % 1000000) AS InvoiceNo,
  CASE WHEN l_partkey % 50 = 0 THEN 'POST' ELSE printf('%05d', l_partkey % 100000)
    || CASE WHEN l_partkey >= 100000 THEN chr(CAST(65 + (l_partkey // 100000) % 26 AS INTEGER)) ELSE '' END
    END AS StockCode,
  upper(p_name) AS Description,
  CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_quantity AS BIGINT) AS Quantity,
  strftime(o_orderdate + to_minutes(o_orderkey % 1440), '%-m/%-d/%Y %-H:%M') AS InvoiceDate,
  CAST(CAST(p_retailprice AS DECIMAL(10,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
    AS DECIMAL(18,4)) AS UnitPrice,
  CAST(o_custkey AS VARCHAR) AS CustomerID,
  n_name AS Country
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

_TABLES["text_lines"] = """
SELECT InvoiceNo, StockCode, Description, CAST(Quantity AS VARCHAR) AS Quantity, InvoiceDate,
  CAST(UnitPrice AS VARCHAR) AS UnitPrice, CustomerID, Country FROM retail_lines
"""


def _grain(lines: str) -> str:
    """Rows per invoice and product; prices are exact decimals, also where messages hold them as numbers."""
    return f"""
SELECT InvoiceNo, StockCode, CAST(SUM(Quantity) AS BIGINT) AS Quantity,
  SUM(Quantity * UnitPrice) AS line_revenue,
  MIN(strptime(InvoiceDate, '%m/%d/%Y %H:%M')) AS invoice_ts,
  MIN(Description) AS Description, MIN(CustomerID) AS CustomerID, MIN(Country) AS Country,
  bool_or(Quantity < 0 OR starts_with(upper(InvoiceNo), 'C')) AS is_cancellation,
  CASE WHEN SUM(Quantity) <> 0 THEN CAST(SUM(Quantity * UnitPrice) AS DOUBLE) / CAST(SUM(Quantity) AS BIGINT)
       ELSE CAST(MIN(UnitPrice) AS DOUBLE) END AS UnitPrice,
  FALSE AS _injected
FROM (SELECT DISTINCT * REPLACE (CAST(UnitPrice AS DECIMAL(18,4)) AS UnitPrice)
      FROM (SELECT DISTINCT {_BUSINESS} FROM {lines}))
WHERE regexp_matches(StockCode, '^[0-9]{{5}}[A-Za-z]?$')
GROUP BY InvoiceNo, StockCode
"""


_TABLES["grain"] = _grain("retail_lines")

_SHOW_SILVER = f"""InvoiceNo, StockCode, Quantity, CAST(line_revenue AS DOUBLE) AS line_revenue,
  strftime(invoice_ts, '%Y-%m-%d %H:%M:%S') AS invoice_ts, Description, CustomerID, Country,
  is_cancellation, {_six("UnitPrice")} AS UnitPrice, _injected"""


def _product_tables(prefix: str, grain: str) -> None:
    """Table expressions from a silver table to the ranked product table."""
    p = prefix
    _TABLES[f"{p}sales"] = f"SELECT * FROM {grain} WHERE NOT is_cancellation AND NOT _injected"
    _TABLES[f"{p}top3"] = f"""
SELECT StockCode, string_agg(Country, ', ' ORDER BY rn) AS top_countries
FROM (SELECT StockCode, Country,
        row_number() OVER (PARTITION BY StockCode ORDER BY SUM(line_revenue) DESC, Country) AS rn
      FROM {p}sales GROUP BY StockCode, Country)
WHERE rn <= 3 GROUP BY StockCode
"""
    _TABLES[f"{p}gold"] = f"""
SELECT StockCode, Description, total_quantity, total_revenue, num_invoices, top_countries,
  CAST(row_number() OVER (ORDER BY total_revenue DESC, StockCode) AS INTEGER) AS revenue_rank,
  CAST(COUNT(*) OVER () AS INTEGER) AS total_products
FROM (SELECT StockCode, MIN(Description) AS Description, CAST(SUM(Quantity) AS BIGINT) AS total_quantity,
        CAST(round(SUM(line_revenue), 2) AS DOUBLE) AS total_revenue,
        COUNT(DISTINCT InvoiceNo) AS num_invoices
      FROM {p}sales GROUP BY StockCode) LEFT JOIN {p}top3 USING (StockCode)
"""


_product_tables("", "grain")
_product_tables("accepted_", "accepted_grain")

# Messages and contract

_TABLES["messages"] = r"""
SELECT line_id AS source_offset, CAST(line_id % 4 AS INTEGER) AS source_partition,
  CASE defect WHEN 9 THEN '{"InvoiceNo": broken' WHEN 10 THEN '["not", "an", "object"]' WHEN 17 THEN ''
  ELSE '{' || concat_ws(', ',
    '"InvoiceNo": ' || CASE defect WHEN 0 THEN '"FREE-STUFF"' WHEN 8 THEN '"  ' || InvoiceNo || ' "'
      WHEN 23 THEN 'null' ELSE '"' || InvoiceNo || '"' END,
    '"StockCode": ' || CASE defect WHEN 4 THEN '""' WHEN 24 THEN NULL ELSE '"' || StockCode || '"' END,
    '"Description": ' || CASE defect WHEN 6 THEN 'null' WHEN 20 THEN NULL ELSE '"' || Description || '"' END,
    '"Quantity": ' || CASE defect WHEN 2 THEN '"many"' WHEN 7 THEN '"' || Quantity || '.0"' WHEN 11 THEN '"6.5"'
      WHEN 13 THEN CAST(Quantity AS VARCHAR) WHEN 15 THEN '"1_000"' WHEN 16 THEN Quantity || '.5'
      WHEN 18 THEN '" +7 "' ELSE '"' || Quantity || '"' END,
    '"InvoiceDate": ' || CASE defect WHEN 1 THEN '"not-a-date"' WHEN 19 THEN '"2/30/2010 8:26"'
      WHEN 21 THEN '"' || replace(InvoiceDate, ' ', '  ') || '"' ELSE '"' || InvoiceDate || '"' END,
    '"UnitPrice": ' || CASE defect WHEN 11 THEN '"abc"' WHEN 22 THEN CAST(UnitPrice AS VARCHAR)
      ELSE '"' || UnitPrice || '"' END,
    '"CustomerID": ' || CASE defect WHEN 5 THEN NULL WHEN 12 THEN CustomerID ELSE '"' || CustomerID || '"' END,
    '"Country": ' || CASE defect WHEN 3 THEN '"   "' WHEN 14 THEN NULL ELSE '"' || Country || '"' END
  ) || '}' END AS payload
FROM retail_lines
"""

_FIELDS = _BUSINESS.split(", ")

_TABLES["parsed"] = (
    "SELECT *, "
    + ", ".join(
        f"CASE WHEN is_object THEN json_type(doc, '$.{f}') END AS k_{f}, "
        f"CASE WHEN is_object THEN json_extract_string(doc, '$.{f}') END AS t_{f}"
        for f in _FIELDS
    )
    + """ FROM (SELECT *, CASE WHEN json_valid(payload) THEN payload END AS doc,
  coalesce(CASE WHEN json_valid(payload) THEN json_type(payload) END = 'OBJECT', FALSE) AS is_object
  FROM messages)"""
)

_NUMBER = "('VARCHAR', 'BIGINT', 'UBIGINT', 'DOUBLE')"
_OK = {
    "InvoiceNo": "k_InvoiceNo = 'VARCHAR' AND regexp_matches(trim(t_InvoiceNo), '^[A-Za-z]?[0-9]{5,6}$')",
    "StockCode": "k_StockCode = 'VARCHAR' AND trim(t_StockCode) <> ''",
    "Description": "k_Description IS NULL OR k_Description = 'VARCHAR'",
    "Quantity": f"k_Quantity IN {_NUMBER} "
    r"AND regexp_matches(trim(t_Quantity), '^[+-]?[0-9]+(_[0-9]+)*(\.0+)?$')",
    "InvoiceDate": f"k_InvoiceDate = 'VARCHAR' AND {_DATE.format('t_InvoiceDate')} IS NOT NULL",
    "UnitPrice": f"k_UnitPrice IN {_NUMBER} AND TRY_CAST(trim(t_UnitPrice) AS DOUBLE) IS NOT NULL",
    "CustomerID": "k_CustomerID IS NULL OR k_CustomerID = 'VARCHAR'",
    "Country": "k_Country = 'VARCHAR' AND trim(t_Country) <> ''",
}
_TABLES["checked"] = (
    "SELECT *, CASE WHEN doc IS NULL THEN 'payload is not valid JSON' "
    "WHEN NOT is_object THEN 'payload is not a JSON object' WHEN failed <> '' THEN "
    "(length(failed) - length(replace(failed, ',', '')) + 1) || ' validation error' "
    "|| CASE WHEN contains(failed, ',') THEN 's' ELSE '' END || ' for RetailTransaction | ' "
    "|| split_part(failed, ',', 1) END AS reason "
    "FROM (SELECT *, CASE WHEN is_object THEN concat_ws(',', "
    + ", ".join(f"CASE WHEN NOT coalesce({ok}, FALSE) THEN '{f}' END" for f, ok in _OK.items())
    + ") ELSE '' END AS failed FROM parsed)"
)

_VALUES = """trim(t_InvoiceNo) AS InvoiceNo, trim(t_StockCode) AS StockCode,
  coalesce(t_Description, '') AS Description,
  CAST(regexp_replace(regexp_replace(trim(t_Quantity), '\\.0+$', ''), '[_+]', '', 'g') AS BIGINT) AS Quantity,
  trim(t_InvoiceDate) AS InvoiceDate, CAST(trim(t_UnitPrice) AS DOUBLE) AS UnitPrice,
  coalesce(t_CustomerID, '') AS CustomerID, trim(t_Country) AS Country"""

_TABLES["accepted"] = f"SELECT {_VALUES}, source_offset, source_partition FROM checked WHERE reason IS NULL"

_REJECTS = (
    "SELECT "
    + ", ".join(f"t_{f} AS raw_{f}" for f in _FIELDS)
    + ", payload, reason AS rejection_reason, failed AS failed_fields, source_offset, source_partition "
    "FROM checked WHERE reason IS NOT NULL"
)

_TABLES["accepted_grain"] = _grain("accepted").replace("strptime(InvoiceDate,", "strptime(regexp_replace(trim(InvoiceDate), '\\s+', ' ', 'g'),")

# Increments

_TABLES["numbered"] = f"""
SELECT *, row_number() OVER (ORDER BY {_BUSINESS}) - 1 AS rn, COUNT(*) OVER () AS total FROM text_lines
"""
_TABLES["first_batch"] = f"SELECT {_BUSINESS} FROM numbered WHERE rn < total * 5 // 7"
_TABLES["second_batch"] = """
SELECT InvoiceNo, StockCode, Description, CASE WHEN rn < total * 2 // 7
    THEN CAST(CAST(Quantity AS BIGINT) * 2 AS VARCHAR) ELSE Quantity END AS Quantity,
  InvoiceDate, UnitPrice, CustomerID, Country
FROM numbered WHERE rn < total * 2 // 7 OR rn >= total * 5 // 7
"""
for _name in ("first", "second"):
    _TABLES[f"{_name}_lines"] = (
        "SELECT InvoiceNo, StockCode, Description, CAST(Quantity AS BIGINT) AS Quantity, InvoiceDate, "
        f"CAST(UnitPrice AS DECIMAL(18,4)) AS UnitPrice, CustomerID, Country FROM {_name}_batch"
    )
    _TABLES[f"{_name}_grain"] = _grain(f"{_name}_lines")

_SAME_KEY = "t.InvoiceNo = s.InvoiceNo AND t.StockCode = s.StockCode"

_TABLES["injected"] = """
SELECT * FROM grain UNION ALL BY NAME
(SELECT * REPLACE (TRUE AS _injected) FROM grain ORDER BY InvoiceNo, StockCode LIMIT 5)
"""

# Gates: failing values per expectation, then one result row each


def _results(suite: str, table: str, expectations: list[tuple[str, str, str, str, str]]) -> str:
    """Expectations as (type, column list, failing rows as SELECT value, missing test, judges nulls)."""
    rows = []
    for position, (kind, columns, failing, missing, judges_nulls) in enumerate(expectations):
        element = f"(SELECT COUNT(*) FROM {table})"
        unexpected = f"(SELECT COUNT(*) FROM ({failing}))"
        absent = f"(SELECT COUNT(*) FROM {table} WHERE {missing})"
        rows.append(
            f"""SELECT '{suite}' AS suite, CAST({position} AS INTEGER) AS position, '{kind}' AS expectation_type,
  '{columns}' AS column_list, {judges_nulls} AS judges_nulls, {element} AS n, {unexpected} AS bad, {absent} AS absent,
  coalesce((SELECT string_agg(coalesce(value, 'null'), '|' ORDER BY value NULLS FIRST) FROM
    (SELECT value FROM ({failing}) ORDER BY value NULLS FIRST LIMIT 20)), '') AS sample,
  coalesce((SELECT string_agg(coalesce(value, 'null') || '=' || times, '|' ORDER BY times DESC, value NULLS FIRST)
    FROM (SELECT value, COUNT(*) AS times FROM ({failing}) GROUP BY value
          ORDER BY times DESC, value NULLS FIRST LIMIT 20)), '') AS counts"""
        )
    return " UNION ALL ".join(rows)


def _show_results(table: str) -> str:
    hidden = "CASE WHEN NOT judges_nulls THEN {0} ELSE -1 END"
    judged = _six("CASE WHEN n > absent THEN bad * 100.0 / (n - absent) ELSE 0.0 END")
    return f"""
SELECT suite, position, expectation_type, column_list, bad = 0 AS success, n AS element_count,
  bad AS unexpected_count, {judged} AS unexpected_percent,
  {hidden.format("absent")} AS missing_count,
  {hidden.format(_six("CASE WHEN n > 0 THEN absent * 100.0 / n ELSE 0.0 END"))} AS missing_percent,
  {hidden.format(_six("CASE WHEN n > 0 THEN bad * 100.0 / n ELSE 0.0 END"))} AS unexpected_percent_total,
  {hidden.format(judged)} AS unexpected_percent_nonmissing,
  sample AS partial_unexpected_list, counts AS partial_unexpected_counts
FROM {table}
"""


def _nulls(table: str, column: str) -> tuple[str, str, str, str, str]:
    failing = f"SELECT CAST(NULL AS VARCHAR) AS value FROM {table} WHERE {column} IS NULL"
    return "expect_column_values_to_not_be_null", column, failing, "FALSE", "TRUE"


_TABLES["bronze"] = "SELECT t_InvoiceNo AS InvoiceNo, t_StockCode AS StockCode FROM parsed"
_TABLES["bronze_results"] = _results(
    "bronze_quality_suite",
    "bronze",
    [
        _nulls("bronze", "InvoiceNo"),
        _nulls("bronze", "StockCode"),
        (
            "expect_column_values_to_match_regex",
            "InvoiceNo",
            "SELECT InvoiceNo AS value FROM bronze WHERE NOT regexp_matches(InvoiceNo, '^[A-Za-z]?[0-9]{5,6}$')",
            "InvoiceNo IS NULL",
            "FALSE",
        ),
    ],
)


def _silver_results(table: str) -> str:
    key = """'{"InvoiceNo":"' || InvoiceNo || '","StockCode":"' || StockCode || '"}'"""
    failing = f"SELECT {key} AS value FROM {table} QUALIFY COUNT(*) OVER (PARTITION BY InvoiceNo, StockCode) > 1"
    return _results(
        "silver_quality_suite",
        table,
        [
            (
                "expect_compound_columns_to_be_unique",
                "InvoiceNo, StockCode",
                failing,
                "InvoiceNo IS NULL AND StockCode IS NULL",
                "FALSE",
            ),
            _nulls(table, "invoice_ts"),
        ],
    )


_TABLES["clean_results"] = _silver_results("grain")
_TABLES["injected_results"] = _silver_results("injected")

# Documents, chunks, searches

_TABLES["plain_docs"] = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(NULL AS VARCHAR) AS title, text FROM documents"
_TABLES["plain_questions"] = "SELECT item_id AS query_id, text FROM benchmark"

_TABLES["product_docs"] = f"""
SELECT StockCode AS doc_id, {_strip("name")} AS title,
  concat_ws(' ',
    name || ' (product code ' || StockCode || ') is a product sold through the online retail catalog.',
    'It generated total revenue of ' || printf('%.2f', total_revenue) || ' over the observed period.',
    'A total of ' || total_quantity || ' units of this product were sold.',
    'It appeared across ' || num_invoices || ' separate invoices.',
    'Its top countries by sales were ' || top_countries || '.',
    'It ranks ' || revenue_rank || ' out of ' || total_products || ' products by total revenue.',
    CASE WHEN revenue_rank = 1 THEN 'It is the top product by revenue: the number one best-selling, '
           || 'highest-revenue product in the entire catalog.'
         WHEN revenue_rank <= 10 THEN 'It is one of the top 10 best-selling products by revenue (number '
           || revenue_rank || ').' END) AS text
FROM (SELECT *, coalesce(nullif(Description, ''), StockCode) AS name FROM gold)
"""

_TABLES["catalog_questions"] = """
SELECT MIN(p_partkey) AS query_id, 'Tell me about ' || p_name || ' products' AS text FROM part GROUP BY p_name
UNION ALL
SELECT -CAST(n_nationkey AS BIGINT) - 1, 'Which product has the highest revenue in ' || n_name || '?' FROM nation
"""


def _expanded(table: str) -> str:
    trigger = " OR ".join(
        f"contains(lower(text), '{word}')" for word in ("top ", "best", "highest", "number one", "#1")
    )
    return f"""
SELECT query_id, text || CASE WHEN {trigger} THEN
  ' (the number one best-selling highest-revenue product, ranks 1 by total revenue)' ELSE '' END AS text
FROM {table}
"""


def _search_tables(prefix: str, docs: str, questions: str) -> None:
    """Table expressions of one corpus: chunks, both searches, fusion, reranking, answers."""
    p = prefix
    _TABLES[f"{p}chunks"] = f"""
SELECT printf('%s_chunk_%03d', doc_id, pos) AS chunk_id, doc_id, CAST(pos AS INTEGER) AS pos,
  '[' || header || '] ' || body AS text
FROM (SELECT doc_id, header, pos, sentences[pos + 1] || CASE WHEN pos + 2 <= len(sentences)
        THEN ' ' || sentences[pos + 2] ELSE '' END AS body
      FROM (SELECT doc_id, header, sentences, unnest(range(0, len(sentences))) AS pos
            FROM (SELECT doc_id, coalesce(nullif(title, ''), doc_id) AS header,
                    string_split(regexp_replace({_strip("text")}, '([.!?]){_SPACE}+', '\\1' || chr(1), 'g'),
                      chr(1)) AS sentences FROM {docs})))
WHERE {_strip("body")} <> ''
"""
    _TABLES[f"{p}tokens"] = f"SELECT doc_id, pos, {_tokens('text')} AS tokens FROM {p}chunks"
    _TABLES[f"{p}postings"] = f"""
SELECT doc_id, pos, term, length, COUNT(*) AS tf
FROM (SELECT doc_id, pos, len(tokens) AS length, unnest(tokens) AS term FROM {p}tokens)
GROUP BY doc_id, pos, term, length
"""
    _TABLES[f"{p}stats"] = (
        f"SELECT COUNT(*) AS n, SUM(len(tokens)) / COUNT(*) AS mean_length FROM {p}tokens"
    )
    _TABLES[f"{p}raw_idf"] = f"""
SELECT term, COUNT(*) AS df, ln(any_value(n) + 0.5 - COUNT(*)) - ln(COUNT(*) + 0.5) AS idf
FROM {p}postings, {p}stats GROUP BY term
"""
    _TABLES[f"{p}terms"] = f"""
SELECT term, df, CASE WHEN idf < 0 THEN 0.25 * (SELECT AVG(idf) FROM {p}raw_idf) ELSE idf END AS idf
FROM {p}raw_idf
"""
    _TABLES[f"{p}asked"] = _expanded(questions) if p != "b_" else f"SELECT * FROM {questions}"
    _TABLES[f"{p}asked_terms"] = f"""
SELECT query_id, term, COUNT(*) AS times
FROM (SELECT query_id, unnest({_tokens("text")}) AS term FROM {p}asked) GROUP BY query_id, term
"""
    _TABLES[f"{p}bm25_all"] = f"""
SELECT query_id, doc_id, pos,
  {_nine("SUM(times * idf * (tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / mean_length))))")} AS score
FROM {p}asked_terms JOIN {p}terms USING (term) JOIN {p}postings USING (term), {p}stats
GROUP BY query_id, doc_id, pos
"""
    _TABLES[f"{p}bm25"] = f"""
SELECT *, printf('%s_chunk_%03d', doc_id, pos) AS chunk_id FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, pos) - 1 AS INTEGER) AS rank
  FROM (SELECT q.query_id, c.doc_id, c.pos, coalesce(score, 0) AS score
        FROM {p}asked q CROSS JOIN {p}chunks c LEFT JOIN {p}bm25_all USING (query_id, doc_id, pos)))
WHERE rank < 15
"""

    def vectors(source: str, keys: str) -> str:
        return f"""
SELECT {keys}, d, SUM(s) AS v
FROM (SELECT {keys}, CAST('0x' || substr(h, 1, 8) AS BIGINT) % 64 AS d,
        CASE WHEN substr(h, 9, 1) < '8' THEN 1 ELSE -1 END AS s
      FROM (SELECT {keys}, md5(unnest({_tokens("text")})) AS h FROM {source}))
GROUP BY {keys}, d HAVING SUM(s) <> 0
"""

    _TABLES[f"{p}chunk_vectors"] = vectors(f"{p}chunks", "doc_id, pos")
    _TABLES[f"{p}chunk_norms"] = f"""
SELECT doc_id, pos, sqrt(coalesce(SUM(v * v), 0)) AS norm
FROM {p}chunks LEFT JOIN {p}chunk_vectors USING (doc_id, pos) GROUP BY doc_id, pos
"""
    _TABLES[f"{p}asked_vectors"] = vectors(f"{p}asked", "query_id")
    _TABLES[f"{p}asked_norms"] = f"""
SELECT query_id, sqrt(coalesce(SUM(v * v), 0)) AS norm
FROM {p}asked LEFT JOIN {p}asked_vectors USING (query_id) GROUP BY query_id
"""
    _TABLES[f"{p}dots"] = f"""
SELECT query_id, doc_id, pos, SUM(a.v * c.v) AS dot
FROM {p}asked_vectors a JOIN {p}chunk_vectors c USING (d) GROUP BY query_id, doc_id, pos
"""
    _TABLES[f"{p}vector_all"] = f"""
SELECT a.query_id, c.doc_id, c.pos, {_nine('''CASE WHEN a.norm > 0 THEN 1 ELSE 0 END
    + CASE WHEN c.norm > 0 THEN 1 ELSE 0 END
    - CASE WHEN a.norm > 0 AND c.norm > 0 THEN 2 * coalesce(dot, 0) / (a.norm * c.norm) ELSE 0 END''')} AS distance
FROM {p}asked_norms a CROSS JOIN {p}chunk_norms c LEFT JOIN {p}dots USING (query_id, doc_id, pos)
"""
    _TABLES[f"{p}vector"] = f"""
SELECT *, printf('%s_chunk_%03d', doc_id, pos) AS chunk_id FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, doc_id, pos) - 1 AS INTEGER) AS rank
  FROM {p}vector_all)
WHERE rank < 15
"""
    _TABLES[f"{p}fused"] = f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id
    ORDER BY score DESC, first_rank NULLS LAST, second_rank NULLS LAST) - 1 AS INTEGER) AS rank
  FROM (SELECT query_id, chunk_id, doc_id, pos, v.rank AS first_rank, b.rank AS second_rank,
          coalesce(1.0::DOUBLE / (v.rank + 61), 0) + coalesce(1.0::DOUBLE / (b.rank + 61), 0) AS score
        FROM {p}vector v FULL JOIN {p}bm25 b USING (query_id, chunk_id, doc_id, pos)))
WHERE rank < 12
"""
    _TABLES[f"{p}reranked"] = f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY pair_score DESC, fused_rank) - 1 AS INTEGER) AS rank
  FROM (SELECT f.query_id, f.chunk_id, f.doc_id, c.text, f.rank AS fused_rank,
          len(list_intersect(list_distinct({_tokens("a.text")}), {_tokens("c.text")})) * 1.0::DOUBLE
            / len(list_distinct({_tokens("a.text")})) AS pair_score
        FROM {p}fused f JOIN {p}chunks c USING (doc_id, pos) JOIN {p}asked a ON a.query_id = f.query_id))
WHERE rank < 3
"""
    _TABLES[f"{p}answers"] = f"""
SELECT q.query_id, q.text AS question, coalesce(answer, '') AS answer,
  'Question: ' || q.text || chr(10) || chr(10) || 'Answer:' || chr(10) || coalesce(answer, '') || chr(10) || chr(10)
    || 'Sources:' || coalesce(sources, '') AS report
FROM {questions} q LEFT JOIN (
  SELECT query_id, string_agg(text || ' [Source ' || (rank + 1) || ']', ' ' ORDER BY rank) AS answer,
    string_agg(chr(10) || '  [Source ' || (rank + 1) || '] chunk_id=' || chunk_id || ' doc_id=' || doc_id
      || ' text="' || text || '"', '' ORDER BY rank) AS sources
  FROM {p}reranked GROUP BY query_id) USING (query_id)
"""


_search_tables("b_", "plain_docs", "plain_questions")  # the keyword search alone, questions as asked
_search_tables("d_", "plain_docs", "plain_questions")  # the text collection
_search_tables("c_", "product_docs", "catalog_questions")  # the product catalog


def _sql(select: str) -> str:
    """``select`` with every table expression it reads, directly or not, in front."""
    order: list[str] = []

    def visit(sql: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN|,)\s+([a-z]\w*)", sql)):
            if word in _TABLES and word not in order:
                visit(_TABLES[word])
                if word not in order:
                    order.append(word)

    visit(select)
    if not order:
        return select.strip()
    tables = ",\n".join(f"{name} AS MATERIALIZED ({_TABLES[name].strip()})" for name in order)
    return f"WITH {tables}\n{select.strip()}"


def oracle_sql() -> dict[str, str]:
    unit = "CAST(UnitPrice AS DOUBLE) AS UnitPrice"
    shown_lines = f"InvoiceNo, StockCode, Description, Quantity, InvoiceDate, {unit}, CustomerID, Country"
    json_object = "json_object(" + ", ".join(f"'{f}', {f}" for f in _FIELDS) + ")"
    accepted = "SELECT * FROM accepted"
    results = {
        "scan_csv_strings": "SELECT * FROM text_lines",
        "format_invoice_date": "SELECT o_orderkey, strftime(o_orderdate + to_minutes(o_orderkey % 1440), "
        "'%-m/%-d/%Y %-H:%M') AS invoice_date FROM orders",
        "to_json_payload": f"SELECT CAST({json_object} AS VARCHAR) AS payload FROM text_lines",
        "bronze_append": f"SELECT {shown_lines}, TRUE AS stamped FROM retail_lines",
        "docs_scan": "SELECT doc_id, title, text FROM plain_docs",
        "schema_diff": "SELECT Country, COUNT(*) AS rows_written, CAST(0 AS BIGINT) AS customers, "
        "'write refused: discount undeclared (double -> None)' AS refused FROM grain GROUP BY Country",
        "contract_valid": accepted,
        "contract_rejects": _REJECTS,
        "contract_summary": "SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, "
        "coalesce(reason, '') AS reason, COUNT(*) AS messages FROM checked GROUP BY 1, 2",
        "stream_ingest": accepted,
        "dlq_read": _REJECTS,
        "landing_scan": accepted,
        "stream_merge": f"SELECT {_SHOW_SILVER} FROM accepted_grain",
        "layered_run": "SELECT * FROM accepted_gold",
        "dedup_business_cols": f"SELECT {shown_lines} FROM (SELECT DISTINCT {_BUSINESS} FROM retail_lines)",
        "route_non_product": "SELECT line_id, InvoiceNo, StockCode, Description, Quantity, Country "
        "FROM retail_lines WHERE NOT regexp_matches(StockCode, '^[0-9]{5}[A-Za-z]?$')",
        "flag_cancellation": "SELECT line_id, InvoiceNo, StockCode, Quantity, "
        "Quantity < 0 OR starts_with(InvoiceNo, 'C') AS is_cancellation FROM retail_lines",
        "silver_grain": f"SELECT {_SHOW_SILVER} FROM grain",
        "top3_countries": "SELECT StockCode, top_countries FROM top3",
        "gold_product_ranking": "SELECT * FROM gold",
        "gold_top5": "SELECT revenue_rank, StockCode, Description, total_revenue, num_invoices, top_countries "
        "FROM gold ORDER BY revenue_rank LIMIT 5",
        "global_rank": "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) "
        "AS price_rank, COUNT(*) OVER () AS total_orders FROM orders",
        "correction_batch": "SELECT * FROM second_batch",
        "silver_merge": f"SELECT {_SHOW_SILVER} FROM (SELECT * FROM second_grain UNION ALL BY NAME "
        f"SELECT * FROM first_grain t WHERE NOT EXISTS (SELECT 1 FROM second_grain s WHERE {_SAME_KEY}))",
        "bucket_merge": f"SELECT {_SHOW_SILVER} FROM (SELECT * FROM second_grain UNION ALL BY NAME "
        f"SELECT * FROM first_grain t WHERE NOT EXISTS (SELECT 1 FROM second_grain s WHERE {_SAME_KEY}))",
        "merge_metrics": "SELECT "
        f"(SELECT COUNT(*) FROM first_grain t WHERE EXISTS (SELECT 1 FROM second_grain s WHERE {_SAME_KEY})) "
        "AS target_rows_updated, "
        f"(SELECT COUNT(*) FROM second_grain s WHERE NOT EXISTS (SELECT 1 FROM first_grain t WHERE {_SAME_KEY})) "
        "AS target_rows_inserted, (SELECT COUNT(*) FROM second_grain) AS source_rows, "
        f"(SELECT COUNT(*) FROM first_grain t WHERE NOT EXISTS (SELECT 1 FROM second_grain s WHERE {_SAME_KEY})) "
        "AS target_rows_copied",
        "inject_duplicates": f"SELECT {_SHOW_SILVER} FROM injected",
        "predicate_delete": f"SELECT {_SHOW_SILVER} FROM injected WHERE NOT _injected",
        "delete_counts": "SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE _injected) AS rows_removed, "
        "COUNT(*) FILTER (WHERE NOT _injected) AS rows_after FROM injected",
        "gate_bronze": _show_results("bronze_results"),
        "gate_silver": _show_results("clean_results"),
        "gate_results": _show_results("injected_results"),
        "gate_verdict": "SELECT suite, bool_and(bad = 0) AS success, COUNT(*) AS evaluated_expectations, "
        "COUNT(*) FILTER (WHERE bad = 0) AS successful_expectations, "
        "COUNT(*) FILTER (WHERE bad > 0) AS unsuccessful_expectations, "
        f"{_six('COUNT(*) FILTER (WHERE bad = 0) * 100.0 / COUNT(*)')} AS success_percent FROM "
        "(SELECT suite, bad FROM bronze_results UNION ALL SELECT suite, bad FROM injected_results) GROUP BY suite",
        "run_summary": "SELECT run_id, job, strftime(MIN(ts), '%Y-%m-%d %H:%M:%S.%f') AS started_at, "
        "strftime(MAX(ts), '%Y-%m-%d %H:%M:%S.%f') AS ended_at, "
        "arg_max(state, (ts, CASE WHEN state = 'START' THEN 0 ELSE 1 END, state)) AS state, COUNT(*) AS events, "
        "date_diff('microsecond', MIN(ts), MAX(ts)) AS duration_us FROM "
        "(SELECT 'run-' || user_id AS run_id, event_type AS job, ts, "
        "['START', 'COMPLETE', 'FAIL'][event_id % 3 + 1] AS state FROM events) GROUP BY run_id, job",
        "product_documents": "SELECT * FROM product_docs",
        "chunk_sentences": "SELECT * FROM d_chunks",
        "chunks_per_doc": "SELECT doc_id, COUNT(*) AS chunks FROM d_chunks GROUP BY doc_id",
        "bm25_index": f"SELECT term, df, {_six('idf')} AS idf FROM b_terms",
        "bm25_lengths": "SELECT doc_id, COUNT(DISTINCT pos) AS chunks, COUNT(*) AS postings, "
        "CAST(SUM(tf) AS BIGINT) AS tokens FROM b_postings GROUP BY doc_id",
        "bm25_topk": f"SELECT query_id, rank, chunk_id, doc_id, pos, {_six('score')} AS score FROM b_bm25",
        "bm25_stored_topk": f"SELECT query_id, rank, chunk_id, doc_id, pos, {_six('score')} AS score FROM b_bm25",
        "vector_topk": f"""
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, {_six("distance")} AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) - 1 AS rank
  FROM (SELECT query_id, vec_id, {_nine("power(list_distance(CAST(e.embedding AS DOUBLE[]), c.embedding), 2)")} AS distance
        FROM embeddings e CROSS JOIN (
          SELECT label AS query_id, list(mean ORDER BY dim) AS embedding
          FROM (SELECT label, dim, AVG(CAST(value AS DOUBLE)) AS mean
                FROM (SELECT label, unnest(embedding) AS value,
                        unnest(range(1, len(embedding) + 1)) AS dim FROM embeddings)
                GROUP BY label, dim) GROUP BY label) c))
WHERE rank < 15
""",
        "vector_lists_topk": f"""
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, {_six("distance")} AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) - 1 AS rank
  FROM (SELECT q.vec_id AS query_id, e.vec_id,
               {_nine("power(list_distance(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 2)")} AS distance
        FROM embeddings e CROSS JOIN (SELECT * FROM embeddings WHERE vec_id % 20 = 0) q))
WHERE rank < 15
""",
        "expand_query": _expanded("(SELECT * FROM catalog_questions UNION ALL SELECT * FROM plain_questions)"),
        "embed_chunks": f"""
SELECT chunk_id, coalesce(places, '') AS places, {_six("CASE WHEN places IS NULL THEN 0 ELSE 1 END")} AS squares
FROM d_chunks LEFT JOIN (
  SELECT doc_id, pos, string_agg(d || CASE WHEN v > 0 THEN '+' ELSE '-' END, ' ' ORDER BY d) AS places
  FROM d_chunk_vectors GROUP BY doc_id, pos) USING (doc_id, pos)
""",
        "rrf_fusion": "SELECT query_id, rank, chunk_id, coalesce(first_rank, -1) AS vector_rank, "
        "coalesce(second_rank, -1) AS bm25_rank, round(score, 9) AS score FROM d_fused",
        "rerank_topk": f"SELECT query_id, rank, chunk_id, fused_rank, {_six('pair_score')} AS pair_score FROM d_reranked",
        "retrieval_compare": "SELECT query_id, CAST(rank + 1 AS INTEGER) AS place, "
        + ", ".join(
            f"coalesce(MIN(CASE WHEN stage = '{s}' THEN chunk_id END), '-') AS {s}"
            for s in ("bm25", "vector", "rrf", "rerank")
        )
        + " FROM ("
        + " UNION ALL ".join(
            f"SELECT '{s}' AS stage, query_id, rank, chunk_id FROM d_{t}"
            for s, t in (("bm25", "bm25"), ("vector", "vector"), ("rrf", "fused"), ("rerank", "reranked"))
        )
        + ") WHERE rank < 3 GROUP BY query_id, rank",
        "compose_answer": "SELECT * FROM d_answers",
        "catalog_answers": "SELECT * FROM c_answers",
    }
    return {name: _sql(select) for name, select in results.items()}
