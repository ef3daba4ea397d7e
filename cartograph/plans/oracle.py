"""DuckDB SQL twins of the named queries, for the driver's correctness check.

The SQL is generated from the test tables' schema: one ``UNION ALL`` arm per
table or column. Value strings are Spark's casts re-created in DuckDB
(Java's ``Float.toString`` form for small and large numbers), so keys,
ranks and ties agree. Rounding, names, scores and tiers use the same SQL
text as the Spark expressions (:mod:`cartograph.functions`).
"""

from __future__ import annotations

import difflib

from .. import config as C
from ..functions.names import levenshtein_ratio_sql, name_similarity_sql, token_jaccard_sql
from ..functions.rounding import py_round_sql
from ..functions.scoring import cardinality_fit_sql, confidence_sql, evidence_sql, tier_sql
from ..functions.semantic_type import semantic_type_sql
from ..functions.text import py_title_sql
from ..operators.semantic import RULE_CONFIDENCE

# The driver's test tables: (view, [(column, DuckDB type)]), in file order.
TEST_TABLES = [
    ("region", [("r_regionkey", "INTEGER"), ("r_name", "VARCHAR")]),
    ("nation", [("n_nationkey", "INTEGER"), ("n_name", "VARCHAR"), ("n_regionkey", "INTEGER")]),
    ("customer", [("c_custkey", "BIGINT"), ("c_name", "VARCHAR"), ("c_nationkey", "INTEGER"),
                  ("c_acctbal", "DOUBLE"), ("c_mktsegment", "VARCHAR")]),
    ("supplier", [("s_suppkey", "BIGINT"), ("s_name", "VARCHAR"), ("s_nationkey", "INTEGER"),
                  ("s_acctbal", "DOUBLE")]),
    ("part", [("p_partkey", "BIGINT"), ("p_name", "VARCHAR"), ("p_brand", "VARCHAR"),
              ("p_type", "VARCHAR"), ("p_size", "INTEGER"), ("p_retailprice", "DOUBLE")]),
    ("orders", [("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "VARCHAR"),
                ("o_totalprice", "DOUBLE"), ("o_orderdate", "TIMESTAMP"),
                ("o_orderpriority", "VARCHAR")]),
    ("lineitem", [("l_orderkey", "BIGINT"), ("l_partkey", "BIGINT"), ("l_suppkey", "BIGINT"),
                  ("l_linenumber", "INTEGER"), ("l_quantity", "DOUBLE"),
                  ("l_extendedprice", "DOUBLE"), ("l_discount", "DOUBLE"), ("l_tax", "DOUBLE"),
                  ("l_returnflag", "VARCHAR"), ("l_linestatus", "VARCHAR"),
                  ("l_shipdate", "TIMESTAMP")]),
    ("events", [("event_id", "BIGINT"), ("ts", "TIMESTAMP"), ("user_id", "BIGINT"),
                ("event_type", "VARCHAR"), ("value", "DOUBLE"), ("props", "VARCHAR")]),
    ("documents", [("doc_id", "BIGINT"), ("text", "VARCHAR"), ("lang", "VARCHAR"),
                   ("source", "VARCHAR"), ("n_chars", "BIGINT")]),
    ("embeddings", [("vec_id", "BIGINT"), ("embedding", "FLOAT[]"), ("label", "INTEGER")]),
    ("pages", [("page_id", "BIGINT"), ("url", "VARCHAR"), ("html", "VARCHAR")]),
    ("benchmark", [("item_id", "BIGINT"), ("text", "VARCHAR")]),
    ("labels", [("doc_id", "BIGINT"), ("quality", "INTEGER"), ("toxic", "INTEGER")]),
    ("conversations", [("conv_id", "BIGINT"), ("turn", "BIGINT"), ("role", "VARCHAR"),
                       ("text", "VARCHAR")]),
]

SPARK_DTYPE = {"TINYINT": "ByteType()", "SMALLINT": "ShortType()", "INTEGER": "IntegerType()",
               "BIGINT": "LongType()", "FLOAT": "FloatType()", "DOUBLE": "DoubleType()",
               "VARCHAR": "StringType()", "BOOLEAN": "BooleanType()", "DATE": "DateType()",
               "TIMESTAMP": "TimestampNTZType()", "BLOB": "BinaryType()",
               "FLOAT[]": "ArrayType(FloatType(), True)"}
TYPE_CLASS = {"TINYINT": "numeric", "SMALLINT": "numeric", "INTEGER": "numeric",
              "BIGINT": "numeric", "FLOAT": "numeric", "DOUBLE": "numeric", "VARCHAR": "string",
              "BOOLEAN": "boolean", "DATE": "datetime", "TIMESTAMP": "datetime",
              "BLOB": "binary", "FLOAT[]": "nested"}
KEY_EXCLUDED = ("monetary_amount", "boolean_flag", "datetime", "nested")


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _file(view: str) -> str:
    return _s(f"{view}.parquet")


def java_num(x: str) -> str:
    """Spark's cast of a float/double to string (Java ``toString``):
    plain between 1e-3 and 1e7, else ``d.dddE±n``."""
    a = f"abs({x})"
    r = f"CAST({a} AS VARCHAR)"
    frac = f"split_part({r}, '.', 2)"
    ip = f"split_part({r}, '.', 1)"
    digits = (f"rtrim(CASE WHEN {r} LIKE '%e%' THEN replace(split_part({r}, 'e', 1), '.', '') "
              f"WHEN {a} < 1 THEN ltrim({frac}, '0') ELSE ({ip} || {frac}) END, '0')")
    exp = (f"(CASE WHEN {r} LIKE '%e%' THEN CAST(split_part({r}, 'e', 2) AS INTEGER) "
           f"WHEN {a} < 1 THEN -(length({frac}) - length(ltrim({frac}, '0'))) - 1 "
           f"ELSE length({ip}) - 1 END)")
    sign = f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END)"
    sci = (f"({sign} || substr({digits}, 1, 1) || '.' || (CASE WHEN length({digits}) > 1 "
           f"THEN substr({digits}, 2) ELSE '0' END) || 'E' || CAST({exp} AS VARCHAR))")
    return (f"(CASE WHEN {x} IS NULL THEN NULL WHEN isnan({x}) THEN 'NaN' "
            f"WHEN isinf({x}) THEN (CASE WHEN {x} > 0 THEN 'Infinity' ELSE '-Infinity' END) "
            f"WHEN {x} = 0 OR ({a} >= 0.001 AND {a} < 10000000) THEN CAST({x} AS VARCHAR) "
            f"ELSE {sci} END)")


def display(expr: str, t: str, normalise: bool = False) -> str:
    """Spark's ``cast(x as string)`` of a value of DuckDB type ``t``."""
    if t in ("DOUBLE", "FLOAT"):
        return java_num(f"({expr} + 0.0)" if normalise else expr)
    if t == "VARCHAR":
        return expr
    if t == "FLOAT[]":
        return (f"(CASE WHEN {expr} IS NULL THEN NULL ELSE '[' || array_to_string(list_transform("
                f"{expr}, lambda x: coalesce({java_num('x')}, 'null')), ', ') || ']' END)")
    if t == "BLOB":
        return f"hex({expr})"
    return f"CAST({expr} AS VARCHAR)"


def _columns():
    for view, cols in TEST_TABLES:
        for i, (name, t) in enumerate(cols):
            yield view, i, name, t


# ---- shared CTEs ------------------------------------------------------------------

def _cols_cte() -> str:
    rows = ", ".join(f"({_file(v)}, {_s(n)}, {i}, {_s(SPARK_DTYPE[t])}, {_s(TYPE_CLASS[t])})"
                     for v, i, n, t in _columns())
    return (f"cols AS (SELECT * FROM (VALUES {rows}) "
            f"t(table_name, column_name, ordinal, dtype, type_class))")


def _vals_cte() -> str:
    arms = []
    for v, i, n, t in _columns():
        vs = display(_q(n), t, normalise=True)
        arms.append(f"SELECT {_file(v)} AS table_name, {_s(n)} AS column_name, {i} AS ordinal, "
                    f"{vs} AS value, {vs} AS key FROM {v}")
    return "vals AS (" + " UNION ALL ".join(arms) + ")"


def _stats_cte() -> str:
    arms = []
    for v, i, n, t in _columns():
        c = _q(n)
        numeric = TYPE_CLASS[t] == "numeric"
        arms.append(
            f"SELECT {_file(v)} AS table_name, {_s(n)} AS column_name, count(*) AS total_rows, "
            f"count({c}) AS non_null, {display(f'min({c})', t, normalise=True)} AS min_value, "
            f"{display(f'max({c})', t, normalise=True)} AS max_value, "
            f"{f'(CAST(min({c}) AS DOUBLE) + 0.0)' if numeric else 'CAST(NULL AS DOUBLE)'} AS min_num, "
            f"{f'(CAST(max({c}) AS DOUBLE) + 0.0)' if numeric else 'CAST(NULL AS DOUBLE)'} AS max_num, "
            f"{f'CAST(avg({c}) AS DOUBLE)' if numeric else 'CAST(NULL AS DOUBLE)'} AS mean_raw "
            f"FROM {v}")
    return "stats AS (" + " UNION ALL ".join(arms) + ")"


def _profile_ctes(n_top: int = 10) -> list[str]:
    nulls = "(s.total_rows - s.non_null)"
    return [
        _cols_cte(), _vals_cte(), _stats_cte(),
        "freq AS (SELECT table_name, column_name, ordinal, key, min(value) AS value, "
        "count(*) AS n FROM vals GROUP BY table_name, column_name, ordinal, key)",
        "card AS (SELECT table_name, column_name, count(*) AS distinct_count FROM freq "
        "GROUP BY table_name, column_name)",
        "top AS (SELECT *, row_number() OVER (PARTITION BY table_name, column_name "
        "ORDER BY n DESC, key ASC NULLS LAST) AS rank FROM freq)",
        f"samples AS (SELECT table_name, column_name, list(value ORDER BY rank) AS sample_values "
        f"FROM top WHERE rank <= {n_top} AND key IS NOT NULL GROUP BY table_name, column_name)",
        "prof0 AS (SELECT c.table_name, c.column_name, c.ordinal, c.dtype, c.type_class, "
        f"s.total_rows, {nulls} AS null_count, "
        f"coalesce({py_round_sql(f'{nulls} / nullif(s.total_rows, 0)', 4)}, 0.0) AS null_rate, "
        "coalesce(d.distinct_count, 0) AS distinct_count, "
        "(coalesce(d.distinct_count, 0) = s.total_rows AND s.total_rows > 0) AS is_unique, "
        "s.min_value, s.max_value, s.min_num, s.max_num, "
        f"{py_round_sql('s.mean_raw', 4)} AS mean_value, "
        "coalesce(sm.sample_values, []::VARCHAR[]) AS sample_values "
        "FROM cols c JOIN stats s USING (table_name, column_name) "
        "LEFT JOIN card d USING (table_name, column_name) "
        "LEFT JOIN samples sm USING (table_name, column_name))",
        "prof AS (SELECT *, "
        f"{semantic_type_sql('column_name', 'type_class', 'sample_values', 'is_unique')} "
        "AS inferred_type, (is_unique AND null_count = 0 AND total_rows > 0) AS pk_candidate "
        "FROM prof0)",
    ]


def _difflib_cte() -> str:
    """The standard library's ratio of every pair of the tables' column names."""
    names = sorted({n for _, _, n, _ in _columns()})
    rows = ", ".join(f"({_s(a)}, {_s(b)}, {difflib.SequenceMatcher(None, a.lower(), b.lower()).ratio()!r}::DOUBLE)"
                     for a in names for b in names)
    return f"dl AS (SELECT * FROM (VALUES {rows}) t(source_col, target_col, edit_ratio))"


def _difflib_ctes() -> list[str]:
    """Names, scores and tiers with that ratio."""
    name = py_round_sql(f"CAST(0.5 AS DOUBLE) * {token_jaccard_sql('ov.source_col', 'ov.target_col')} + "
                        "CAST(0.5 AS DOUBLE) * dl.edit_ratio", 4)
    out = [c for c in _relationship_ctes() if not c.startswith("sc AS")]
    at = next(k for k, c in enumerate(out) if c.startswith("cand AS"))
    out[at:at] = [_difflib_cte(), f"sc AS (SELECT ov.*, dl.edit_ratio, {name} AS name_score, "
                  f"{cardinality_fit_sql('pk_unique', 'pk_null_rate', 'fk_unique')} AS cardinality_score "
                  "FROM ov JOIN dl ON ov.source_col = dl.source_col AND ov.target_col = dl.target_col)"]
    return out


def _reply_cases() -> str:
    """The rows that each reply case must give, said outright."""
    given = {0: ("L", "d", "pii", 0.9, "auto_accepted"), 1: ("", "", "low", 0.9, "auto_accepted"),
             2: ("", "", "low", 0.6, "needs_review"), 5: ("", "", "low", 0.5, "needs_review"),
             8: ("", "x ] y", "low", 0.6, "needs_review")}
    chars = {0: 105, 1: 52, 2: 67, 3: 38, 4: 9, 5: 21, 6: 43, 7: 43, 8: 74, 9: 10, 10: 0, 11: 3000}
    named = (0, 1, 2, 3, 5, 7, 8)       # cases that hold the table's first column
    label = py_title_sql("replace(c.column_name, '_', ' ')")
    arms = []
    for k in range(12):
        size = f"{chars[k]}" + (" + length(f.column_name)" if k in named else "")
        back = (f"{label}, 'Could not infer — LLM response parse failure.', 'low', 0.3::DOUBLE, "
                f"'low_confidence', false, CAST({size} AS BIGINT)")
        head = f"SELECT CAST({k} AS BIGINT), c.table_name, "
        tail = "FROM cols c JOIN cols f ON f.table_name = c.table_name AND f.ordinal = 0"
        if k in given:
            a, b, c, d, e = given[k]
            mine = f"{_s(a)}, {_s(b)}, {_s(c)}, {d}::DOUBLE, {_s(e)}, true, CAST({size} AS BIGINT)"
            arms.append(f"{head} c.column_name, {mine} {tail} WHERE c.ordinal = 0")
            arms.append(f"{head} c.column_name, {back} {tail} WHERE c.ordinal > 0")
        else:
            arms.append(f"{head} c.column_name, {back} {tail}")
        if k == 6:
            arms.append(f"{head} 'zzz', '', '', 'low', 0.7::DOUBLE, 'needs_review', true, "
                        f"CAST({size} AS BIGINT) {tail} WHERE c.ordinal = 0")
    names = ("case_no, table_name, column_name, business_label, description, sensitivity, confidence, status, "
             "from_reply, raw_chars")
    return f"SELECT * FROM ({' UNION ALL '.join(arms)}) t({names})"


def _with(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _relationship_ctes(excluded=KEY_EXCLUDED, min_overlap: float = 0.05) -> list[str]:
    ex = ", ".join(_s(e) for e in excluded)
    fk_distinct = "(fk.distinct_count - (CASE WHEN fk.null_count > 0 THEN 1 ELSE 0 END))"
    return _profile_ctes() + [
        "pk AS (SELECT * FROM prof WHERE pk_candidate AND null_count = 0)",
        f"fk AS (SELECT * FROM prof WHERE NOT pk_candidate AND inferred_type NOT IN ({ex}))",
        "m AS (SELECT f.table_name AS source_table, f.column_name AS source_col, "
        "p.table_name AS target_table, p.column_name AS target_col, count(*) AS matched "
        "FROM freq f JOIN fk ON f.table_name = fk.table_name AND f.column_name = fk.column_name "
        "JOIN freq p ON p.key = f.key AND p.table_name <> f.table_name "
        "JOIN pk ON p.table_name = pk.table_name AND p.column_name = pk.column_name "
        "WHERE f.key IS NOT NULL GROUP BY ALL)",
        f"ov0 AS (SELECT m.*, {fk_distinct} AS fk_distinct_values, "
        f"{py_round_sql(f'm.matched / nullif({fk_distinct}, 0)', 4)} AS overlap_score, "
        "fk.is_unique AS fk_unique, pk.is_unique AS pk_unique, pk.null_rate AS pk_null_rate "
        "FROM m JOIN fk ON m.source_table = fk.table_name AND m.source_col = fk.column_name "
        "JOIN pk ON m.target_table = pk.table_name AND m.target_col = pk.column_name)",
        f"ov AS (SELECT * FROM ov0 WHERE overlap_score >= CAST({min_overlap!r} AS DOUBLE))",
        "sc AS (SELECT *, "
        f"{name_similarity_sql('source_col', 'target_col')} AS name_score, "
        f"{cardinality_fit_sql('pk_unique', 'pk_null_rate', 'fk_unique')} AS cardinality_score "
        "FROM ov)",
        f"cand AS (SELECT *, {confidence_sql('overlap_score', 'name_score', 'cardinality_score')} "
        "AS confidence FROM sc)",
        f"tiers AS (SELECT *, {tier_sql('confidence', C.AUTO_ACCEPT, C.HUMAN_REVIEW, 'discarded')} "
        f"AS status, {evidence_sql('overlap_score', 'name_score', 'cardinality_score')} "
        f"AS evidence, {_s(C.RELATIONSHIP_TYPE)} AS relationship_type FROM cand)",
    ]


def _pct(x: str) -> str:
    return f"(CAST(CAST({py_round_sql(f'{x} * CAST(100.0 AS DOUBLE)', 0)} AS BIGINT) AS VARCHAR) || '%')"


def _semantic_ctes() -> list[str]:
    line = ("('  - ' || column_name || ' | ' || dtype || ' | ' || inferred_type || ' | [' || "
            "array_to_string(sample_values[1:5], ', ') || ']')")
    nl = "chr(10)"
    label = py_title_sql("replace(column_name, '_', ' ')")
    conf = "(CASE " + " ".join(f"WHEN inferred_type = {_s(k)} THEN CAST({v!r} AS DOUBLE)"
                               for k, v in RULE_CONFIDENCE.items()) + " ELSE 0.3 END)"
    sens = ("(CASE WHEN inferred_type IN ('email', 'label_or_name', 'geographic') THEN 'pii' "
            "WHEN regexp_matches(lower(column_name), '(phone|address|e_?mail|ssn)') THEN 'pii' "
            "WHEN inferred_type = 'monetary_amount' THEN 'high' "
            "WHEN inferred_type = 'identifier' THEN 'medium' ELSE 'low' END)")
    head, tail = C.STUB_RESPONSE.split("{n}")
    return _relationship_ctes() + [
        "prompts AS (SELECT table_name, 'Table name: ' || table_name || " + nl + " || " + nl +
        " || 'Columns (name | type | inferred_type | sample_values):' || " + nl +
        f" || string_agg({line}, {nl} ORDER BY ordinal) || {nl} || {nl} || "
        f"'Additional context:' || {nl} || '  - Total rows sampled: ' || "
        f"CAST(arg_min(total_rows, ordinal) AS VARCHAR) || {nl} || '  - Null rates range: ' || "
        f"{_pct('min(null_rate)')} || ' – ' || {_pct('max(null_rate)')} AS prompt "
        "FROM prof GROUP BY table_name)",
        f"rules AS (SELECT table_name, column_name, {label} AS business_label, "
        f"{label} || ' (' || inferred_type || ')' AS description, {sens} AS sensitivity, "
        f"{conf} AS confidence FROM prof)",
        f"rules_t AS (SELECT *, {tier_sql('confidence', C.AUTO_ACCEPT, C.HUMAN_REVIEW, 'low_confidence')} "
        "AS status FROM rules)",
        f"stub AS (SELECT p.table_name, p.column_name, {label} AS business_label, "
        f"{_s(C.FALLBACK_DESCRIPTION)} AS description, {_s(C.FALLBACK_SENSITIVITY)} AS sensitivity, "
        f"CAST({C.FALLBACK_CONFIDENCE!r} AS DOUBLE) AS confidence, 'low_confidence' AS status, "
        f"{_s(head)} || CAST(length(q.prompt) AS VARCHAR) || {_s(tail)} AS raw_response "
        "FROM prof p JOIN prompts q USING (table_name))",
    ]


PAIR = "source_table, source_col, target_table, target_col"


def oracle_sql() -> dict[str, str]:
    prof = _profile_ctes()
    rel = _relationship_ctes()
    literal = _relationship_ctes(excluded=C.FK_EXCLUDED_TYPES + ("nested",))
    sem = _semantic_ctes()
    inv_arms = " UNION ALL ".join(
        f"SELECT {_file(v)} AS table_name, 'parquet' AS format, (SELECT count(*) FROM {v}) "
        f"AS row_count, (SELECT count(*) FROM (DESCRIBE {v})) AS n_columns, "
        f"(SELECT string_agg(column_name, ',') FROM (DESCRIBE {v})) AS column_list"
        for v, _ in TEST_TABLES)
    dtype_case = "(CASE column_type " + " ".join(
        f"WHEN {_s(k)} THEN {_s(d)}" for k, d in SPARK_DTYPE.items()) + " ELSE column_type END)"
    class_case = "(CASE column_type " + " ".join(
        f"WHEN {_s(k)} THEN {_s(d)}" for k, d in TYPE_CLASS.items()) + " ELSE 'other' END)"
    col_arms = " UNION ALL ".join(
        f"SELECT {_file(v)} AS table_name, CAST(row_number() OVER () - 1 AS BIGINT) AS ordinal, "
        f"column_name, {dtype_case} AS dtype, {class_case} AS type_class FROM (DESCRIBE {v})"
        for v, _ in TEST_TABLES)
    samples = "array_to_string(sample_values, '|')"
    dl = _difflib_ctes()
    copies = lambda fmt: " UNION ALL ".join(
        f"SELECT {_s(v)} AS table_name, {_s(fmt)} AS format, (SELECT count(*) FROM {v}) AS row_count, "
        f"(SELECT count(*) FROM (DESCRIBE {v})) AS n_columns" for v, _ in TEST_TABLES)
    token = semantic_type_sql("column_name", "type_class", "sample_values", "is_unique", "token")
    return {
        "discover_files": " UNION ALL ".join(f"SELECT {_file(v)} AS file_name, '.parquet' AS extension, "
                                             "true AS has_bytes" for v, _ in TEST_TABLES),
        "discover_csv": copies("csv"),
        "discover_json": copies("json"),
        "profile_sampled": _with([_cols_cte()], "SELECT table_name, column_name, true AS rows_in_bounds, "
                                                "true AS distinct_in_bounds FROM cols"),
        "run_history": "SELECT 'complete' AS status, true AS id_in_form FROM range(2)",
        "result_tables": _with(sem, "SELECT result, n, CAST(1 AS BIGINT) AS runs FROM (VALUES "
                               "('discovery', (SELECT count(DISTINCT table_name) FROM cols)), "
                               "('profiling', (SELECT count(*) FROM prof)), "
                               "('relationship', (SELECT count(*) FROM tiers)), "
                               "('semantic', (SELECT count(*) FROM rules_t)), "
                               "('pipeline_runs', CAST(1 AS BIGINT))) t(result, n)"),
        "result_tables_evolved": _with(sem, "SELECT result, writer, n, CASE WHEN writer IN ('newer', 'narrow') THEN n ELSE 0 END "
                                       "AS reviewed, CASE writer WHEN 'newer' THEN n WHEN 'narrow' THEN 2 * n END AS weight, "
                                       "CASE WHEN writer = 'older' THEN 0 ELSE n END AS known_before, "
                                       "CAST(2 AS BIGINT) AS columns_added FROM (VALUES "
                                       "('discovery', (SELECT count(DISTINCT table_name) FROM cols)), "
                                       "('profiling', (SELECT count(*) FROM prof)), "
                                       "('relationship', (SELECT count(*) FROM tiers)), "
                                       "('semantic', (SELECT count(*) FROM rules_t)), "
                                       "('pipeline_runs', CAST(1 AS BIGINT))) t(result, n), "
                                       "(VALUES ('first'), ('newer'), ('narrow'), ('older')) w(writer)"),
        "run_artefacts": _with(sem, "SELECT 'relationship_candidates' AS artefact, count(*) AS n, max(confidence) AS best, "
                               "CAST(NULL AS VARCHAR) AS status FROM (SELECT confidence FROM tiers "
                               f"ORDER BY confidence DESC LIMIT {C.TOP_ARTEFACT_ROWS}) UNION ALL "
                               "SELECT 'pii_summary', count(*), max(confidence), NULL FROM rules_t WHERE sensitivity = 'pii' "
                               "UNION ALL SELECT 'pipeline_summary', count(*), CAST(count(*) FILTER (WHERE pk_candidate) AS DOUBLE), "
                               "'complete' FROM prof"),
        "capped_fk_columns": _with(rel, "SELECT table_name, column_name, CAST(ordinal AS BIGINT) AS ordinal, "
                                        "ordinal >= 2 AS left_out FROM fk"),
        "infer_semantic_type_token": _with(prof, f"SELECT table_name, column_name, {token} AS inferred_type FROM prof0"),
        "semantic_reply_cases": _with([_cols_cte()], _reply_cases()),
        "name_edit_ratio": _with(dl, "SELECT DISTINCT source_col, target_col, edit_ratio FROM sc"),
        "name_similarity": _with(dl, "SELECT DISTINCT source_col, target_col, name_score FROM sc"),
        "relationship_candidates": _with(dl, f"SELECT {PAIR}, overlap_score, name_score, cardinality_score, confidence, status, "
                                         "evidence, relationship_type FROM tiers"),
        "discovery_inventory": inv_arms,
        "discovery_columns": col_arms,
        "profile_nulls": _with(prof, "SELECT table_name, column_name, total_rows, null_count, "
                                     "null_rate FROM prof"),
        "profile_cardinality": _with(prof, "SELECT table_name, column_name, total_rows, "
                                           "distinct_count, is_unique FROM prof"),
        "profile_min_max": _with(prof, "SELECT table_name, column_name, min_value, max_value, "
                                       "min_num, max_num FROM prof"),
        "profile_mean": _with(prof, "SELECT table_name, column_name, mean_value FROM prof "
                                    "WHERE type_class = 'numeric'"),
        "profile_top_values": _with(prof, "SELECT table_name, column_name, rank, value, "
                                          "n AS count FROM top WHERE rank <= 10 "
                                          "AND key IS NOT NULL"),
        "profile_sample_values": _with(prof, f"SELECT table_name, column_name, {samples} "
                                             "AS sample_values FROM prof"),
        "column_values": _with(prof, "SELECT table_name, column_name, count(*) AS distinct_values, "
                                     "CAST(sum(n) AS BIGINT) AS rows, max(n) AS max_count, "
                                     "count(*) FILTER (WHERE n = 1) AS singletons FROM freq "
                                     "GROUP BY table_name, column_name"),
        "infer_semantic_type": _with(prof, "SELECT table_name, column_name, inferred_type "
                                           "FROM prof"),
        "column_profiles": _with(prof, "SELECT table_name, column_name, dtype, total_rows, "
                                       "null_count, null_rate, distinct_count, is_unique, "
                                       "min_value, max_value, mean_value, "
                                       f"{samples} AS sample_values, inferred_type, pk_candidate "
                                       "FROM prof"),
        "pk_candidates": _with(rel, "SELECT table_name, column_name FROM pk"),
        "fk_candidate_columns": _with(rel, "SELECT table_name, column_name, inferred_type "
                                           "FROM fk"),
        "candidate_pairs": _with(rel, "SELECT fk.table_name, fk.column_name, "
                                      "(SELECT count(*) FROM pk) - (SELECT count(*) FROM pk p "
                                      "WHERE p.table_name = fk.table_name) AS pk_partners "
                                      "FROM fk"),
        "value_overlap": _with(rel, f"SELECT {PAIR}, matched, fk_distinct_values, "
                                    "overlap_score FROM ov"),
        "name_token_jaccard": _with(rel, "SELECT source_col, target_col, "
                                         f"{token_jaccard_sql('source_col', 'target_col')} "
                                         "AS jaccard FROM (SELECT DISTINCT source_col, "
                                         "target_col FROM ov)"),
        "name_levenshtein_ratio": _with(rel, "SELECT source_col, target_col, "
                                             f"{levenshtein_ratio_sql('source_col', 'target_col')} "
                                             "AS edit_ratio FROM (SELECT DISTINCT source_col, "
                                             "target_col FROM ov)"),
        "cardinality_fit": _with(rel, f"SELECT {PAIR}, cardinality_score FROM tiers"),
        "relationship_confidence": _with(rel, f"SELECT {PAIR}, overlap_score, name_score, "
                                              "cardinality_score, confidence FROM tiers"),
        "relationship_tiers": _with(rel, f"SELECT {PAIR}, confidence, status, evidence, "
                                         "relationship_type FROM tiers"),
        "relationship_tiers_literal": _with(literal, f"SELECT {PAIR}, confidence, status, "
                                                 "evidence FROM tiers"),
        "relationship_top20": _with(rel, f"SELECT {PAIR}, confidence, status FROM tiers "
                                         f"ORDER BY confidence DESC, {PAIR} LIMIT 20"),
        "review_relationships": _with(rel, f"SELECT {PAIR}, confidence FROM tiers "
                                           "WHERE status = 'needs_review'"),
        "semantic_prompts": _with(sem, "SELECT table_name, prompt FROM prompts"),
        "semantic_parse": _with(sem, "SELECT table_name, column_name, business_label, "
                                     "description, sensitivity, confidence FROM rules"),
        "semantic_fallback": _with(sem, "SELECT table_name, column_name, business_label, "
                                        "description, sensitivity, confidence, status, "
                                        "raw_response FROM stub"),
        "semantic_annotations": _with(sem, "SELECT table_name, column_name, business_label, "
                                           "sensitivity, confidence, status FROM rules_t"),
        "pii_columns": _with(sem, "SELECT table_name, column_name, business_label, confidence "
                                  "FROM rules_t WHERE sensitivity = 'pii'"),
        "review_semantics": _with(sem, "SELECT table_name, column_name, business_label, "
                                       "confidence FROM rules_t WHERE status = 'needs_review'"),
        "review_counts": _with(sem, "SELECT 'relationships' AS kind, count(*) AS pending FROM "
                                    "tiers WHERE status = 'needs_review' UNION ALL "
                                    "SELECT 'semantics', count(*) FROM rules_t "
                                    "WHERE status = 'needs_review'"),
        "run_summary": _with(sem, "SELECT (SELECT count(*) FROM (SELECT DISTINCT table_name "
                                  "FROM cols)) AS datasets_found, "
                                  "(SELECT count(*) FROM prof) AS columns_profiled, "
                                  "(SELECT count(*) FROM prof WHERE pk_candidate) AS pk_candidates, "
                                  "(SELECT count(*) FROM tiers WHERE status = 'auto_accepted') "
                                  "AS rel_auto_accepted, "
                                  "(SELECT count(*) FROM tiers WHERE status = 'needs_review') "
                                  "AS rel_needs_review, "
                                  "(SELECT count(*) FROM tiers WHERE status = 'discarded') "
                                  "AS rel_discarded, "
                                  "(SELECT count(*) FROM rules_t WHERE status = 'auto_accepted') "
                                  "AS sem_auto_accepted, "
                                  "(SELECT count(*) FROM rules_t WHERE status = 'needs_review') "
                                  "AS sem_needs_review, "
                                  "(SELECT count(*) FROM rules_t WHERE sensitivity = 'pii') "
                                  "AS pii_columns"),
    }
