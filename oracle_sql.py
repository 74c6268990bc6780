"""DuckDB oracle SQL for the registered queries.

Tables ``orders customer nation lineitem events documents ...`` are views over the parquet files.
The posting fixture is rebuilt in SQL with the same rules as ``postlens.sources.fixture``; each
oracle states its query independently of the Spark code. Lists are 1-based in DuckDB.
"""

from __future__ import annotations

from postlens import schema

# ---------------------------------------------------------------------------------------------
# Shared fragments
# ---------------------------------------------------------------------------------------------

POSTINGS_CTE = r"""
src AS (
  SELECT o.o_orderkey AS k,
         CAST(CAST(floor(o.o_totalprice / 12) AS INTEGER) AS VARCHAR) AS lo,
         CAST(CAST(floor(o.o_totalprice / 8) AS INTEGER) AS VARCHAR) AS hi,
         o.o_orderstatus, o.o_orderpriority, c.c_name, c.c_mktsegment, n.n_name
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
lines AS (
  SELECT k AS id, concat_ws('|',
    CAST(k AS VARCHAR),
    'job',
    c_name,
    CASE WHEN k % 17 <> 0 THEN o_orderstatus END,
    CASE WHEN k % 17 <> 0 THEN
      CASE k % 10 WHEN 0 THEN '面议' WHEN 1 THEN '1000元以下' WHEN 2 THEN ''
                  WHEN 3 THEN lo || '-' || hi || '元/月' WHEN 4 THEN '-' || hi
                  WHEN 5 THEN lo || '-' ELSE lo || '-' || hi END
    END,
    CASE WHEN k % 17 <> 0 AND k % 13 <> 0 THEN CASE WHEN k % 7 = 0 THEN '' ELSE n_name END END,
    CASE WHEN k % 17 <> 0 AND k % 13 <> 0 THEN c_mktsegment END,
    CASE WHEN k % 17 <> 0 AND k % 13 <> 0 THEN o_orderpriority END,
    CASE WHEN k % 17 <> 0 AND k % 13 <> 0 THEN
      CASE k % 4 WHEN 0 THEN '1-3年' WHEN 1 THEN '3-5年' WHEN 2 THEN '不限' ELSE '' END
    END,
    CASE WHEN k % 17 <> 0 AND k % 13 <> 0 THEN
      CASE WHEN k % 23 = 0 THEN '' ELSE CASE k % 3 WHEN 0 THEN '本科' WHEN 1 THEN '大专' ELSE '硕士' END END
    END,
    CASE WHEN k % 17 <> 0 AND k % 13 <> 0 THEN
      CASE WHEN k % 11 = 0 THEN '' ELSE
        'Need ' || CASE k % 5 WHEN 0 THEN 'Hadoop' WHEN 1 THEN 'spark' WHEN 2 THEN 'java'
                              WHEN 3 THEN 'javascript' ELSE 'MySQL' END
        || ', 熟悉' || CASE k % 2 WHEN 0 THEN '数据挖掘' ELSE '算法' END || '及Linux'
      END
    END
  ) AS line
  FROM src
),
split_lines AS (
  SELECT id, line, string_split_regex(regexp_replace(line, '[|]+$', ''), '[|]') AS f FROM lines
),
postings AS (
  SELECT id, CAST(CASE WHEN regexp_full_match(line, '[|]+') THEN 0 ELSE len(f) END AS INTEGER) AS n_fields,
         f[5] AS salary, f[6] AS address, f[7] AS company_type, f[8] AS company_size,
         f[9] AS experience, f[10] AS education, f[11] AS skills
  FROM split_lines
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([POSTINGS_CTE, *ctes]) + "\n"


def salary_value(side: int, col: str = "salary") -> str:
    """The integer part of a two-part salary, by splitting: no pattern is shared with the Spark rule."""
    parts = f"string_split(rtrim({col}, '-'), '-')"  # Java drops trailing empty parts
    part = f"{parts}[{side + 1}]"
    digits = f"(CASE WHEN {part}[1] = '+' THEN substring({part}, 2) ELSE {part} END)"
    return (
        f"(CASE WHEN len({parts}) = 2 AND length({digits}) > 0 AND length(translate({digits}, '0123456789', '')) = 0 "
        f"THEN TRY_CAST({digits} AS INTEGER) END)"
    )


def bucket_lo(v: str, grid) -> str:
    """Lower edge of the first bucket of the listed grid that holds the value."""
    start, end, step = grid
    return f"CAST(list_min(list_filter(range({start}, {end}, {step}), lambda lo: CAST({v} AS BIGINT) >= lo AND CAST({v} AS BIGINT) < least(lo + {step}, {end}))) AS INTEGER)"


def bucket_hi(lo: str, grid) -> str:
    _, end, step = grid
    return f"CAST(CASE WHEN {lo} IS NOT NULL THEN least(CAST({lo} AS BIGINT) + {step}, {end}) END AS INTEGER)"


def label(lo: str = "lo", hi: str = "hi") -> str:
    return f"CAST({lo} AS VARCHAR) || '-' || CAST({hi} AS VARCHAR)"


def keep(drop_zero_floor: bool, lo: str = "lo", hi: str = "hi") -> str:
    return f"({lo} IS NOT NULL AND {lo} <> 0)" if drop_zero_floor else f"({hi} IS NOT NULL AND {hi} <> 0)"


def histogram_sql(where: str, side: int, grid, drop_zero_floor: bool = False) -> str:
    lo = bucket_lo(salary_value(side), grid)
    return _with(
        f"b AS (SELECT {lo} AS lo FROM postings WHERE {where})",
        f"bh AS (SELECT lo, {bucket_hi('lo', grid)} AS hi FROM b)",
    ) + (
        f"SELECT {label()} AS bucket, lo, hi, CAST(count(*) AS BIGINT) AS n FROM bh "
        f"WHERE {keep(drop_zero_floor)} GROUP BY lo, hi"
    )


COHORT = (
    f"n_fields >= {schema.GATE_DIMENSIONS} AND experience = '{schema.COHORT_EXPERIENCE}' "
    f"AND education = '{schema.COHORT_EDUCATION}'"
)


def sql_list(words) -> str:
    return ", ".join("('" + w.replace("'", "''") + "')" for w in words)


DICT_CTE = f"dict(word) AS (VALUES {sql_list(schema.DEFAULT_KEYWORDS)})"
STOP_SQL = ", ".join("'" + w + "'" for w in schema.STOP_WORDS)


def word_split(txt: str) -> str:
    """Words by cutting at everything that is neither letter nor digit, Han stretches set apart."""
    return f"list_filter(string_split_regex(regexp_replace(lower({txt}), '(\\p{{Han}}+)', ' \\1 ', 'g'), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"


def occurrences(text: str, word: str, at: str) -> str:
    """Whether ``word`` stands at position ``at`` of ``text`` by the rule of its kind: decided by the
    characters next to it, position by position, not by extracting tokens."""
    before, after = f"substring({text}, {at} - 1, 1)", f"substring({text}, {at} + length({word}), 1)"
    first, last = f"substring({word}, 1, 1)", f"substring({word}, length({word}), 1)"
    letter, alnum, gap = "'[a-z]'", "'[a-z0-9]'", r"'[\s,;|/()，；、。（）：:]'"
    edge = f"({at} = 1 OR {{}}) AND ({at} + length({word}) > length({text}) OR {{}})"
    return f"""(substring({text}, {at}, length({word})) = {word} AND CASE
        WHEN regexp_full_match({word}, '[a-z]+') THEN {edge.format(f"NOT regexp_matches({before}, {letter})", f"NOT regexp_matches({after}, {letter})")}
        WHEN regexp_full_match({word}, '\\p{{Han}}+') THEN true
        WHEN regexp_full_match({word}, '[a-z0-9\\p{{Han}}]+') THEN {edge.format(f"NOT (regexp_matches({before}, {alnum}) AND regexp_matches({first}, {alnum}))", f"NOT (regexp_matches({after}, {alnum}) AND regexp_matches({last}, {alnum}))")}
        ELSE {edge.format(f"regexp_matches({before}, {gap})", f"regexp_matches({after}, {gap})")} END)"""


def found_words(texts: str, words: str = "dict") -> str:
    """``token`` rows: every occurrence of every word of ``words`` in the column ``t`` of ``texts``."""
    return (
        f"SELECT word AS token FROM (SELECT t, word, unnest(range(1, length(t) - length(word) + 2)) AS pos "
        f"FROM {texts}, {words} WHERE contains(t, word)) p WHERE {occurrences('t', 'word', 'pos')}"
    )


def keyword_tokens_cte(where: str) -> list[str]:
    """``kt`` (texts) and ``tok`` (found dictionary words) CTEs."""
    return [DICT_CTE, f"kt AS (SELECT lower(skills) AS t FROM postings WHERE {where})", f"tok AS ({found_words('kt')})"]


def json_agg(key: str = "key", n: str = "n") -> str:
    esc = f"replace(replace({key}, '\\', '\\\\'), '\"', '\\\"')"
    return f"""'{{' || string_agg('"' || {esc} || '":' || CAST({n} AS VARCHAR), ',' ORDER BY {key}) || '}}'"""


DIMS = [(c, q, lab) for c, q, lab in schema.DIMENSIONS]


def dims_union(use: int, where: str, extra: str = "") -> str:
    return "\n      UNION ALL ".join(
        f"SELECT {extra}'{d[use]}' AS dim, {d[0]} AS value FROM postings WHERE {where} AND {d[0]} <> ''" for d in DIMS
    )


def report_rows_sql() -> list[str]:
    g = schema.BATCH_GRID
    ctes = keyed_tokens()
    ctes += [
        f"v AS (SELECT id, n_fields, experience, education, {salary_value(0)} AS v0, {salary_value(1)} AS v1 FROM postings)",
        f"l AS (SELECT *, {bucket_lo('v0', g)} AS lo0, {bucket_lo('v1', g)} AS lo1 FROM v)",
        f"h AS (SELECT *, {bucket_hi('lo0', g)} AS hi0, {bucket_hi('lo1', g)} AS hi1 FROM l)",
        f"""b AS (SELECT id, n_fields, experience, education,
              CASE WHEN {keep(False, 'lo0', 'hi0')} THEN {label('lo0', 'hi0')} END AS b0,
              CASE WHEN {keep(False, 'lo1', 'hi1')} THEN {label('lo1', 'hi1')} END AS b1 FROM h)""",
        f"""rows AS (
      SELECT id, 'salary_0' AS section, b0 AS key FROM b WHERE n_fields = 11 AND b0 IS NOT NULL
      UNION ALL SELECT id, 'salary_1', b1 FROM b WHERE n_fields = 11 AND b1 IS NOT NULL
      UNION ALL SELECT id, 'salary3_0', b0 FROM b WHERE n_fields = 11 AND {COHORT} AND b0 IS NOT NULL
      UNION ALL SELECT id, 'salary3_1', b1 FROM b WHERE n_fields = 11 AND {COHORT} AND b1 IS NOT NULL
      UNION ALL SELECT id, dim, value FROM ({dims_union(1, 'n_fields >= 10', 'id, ')}) d
      UNION ALL SELECT id, 'skill_bg', token FROM ktok
    )""",
    ]
    return ctes


def keyed_tokens() -> list[str]:
    """``ktok`` (id, token): the dictionary words found in each full posting."""
    found = found_words("kt").replace("SELECT word AS token", "SELECT id, word AS token").replace("(SELECT t, word,", "(SELECT id, t, word,")
    return [DICT_CTE, "kt AS (SELECT id, lower(skills) AS t FROM postings WHERE n_fields = 11)", f"ktok AS ({found})"]


def keyed_report(row_key: str) -> list[str]:
    """``krep`` (row_key, section, key, n): the report of each row key, a rule on the posting's id."""
    return [*report_rows_sql(), f"krep AS (SELECT {row_key} AS row_key, section, key, CAST(count(*) AS BIGINT) AS n FROM rows GROUP BY ALL)"]


CELLS_SQL = (
    "SELECT row_key, 'info' AS family, section AS qualifier, "
    + json_agg()
    + " AS value FROM krep GROUP BY row_key, section"
)


def stream_ctes() -> list[str]:
    g = schema.STREAM_GRID
    ctes = keyword_tokens_cte("n_fields = 11")
    ctes += [
        f"sv AS (SELECT n_fields, {salary_value(0)} AS v0, {salary_value(1)} AS v1 FROM postings WHERE n_fields >= 5)",
        f"sl AS (SELECT *, {bucket_lo('v0', g)} AS lo0, {bucket_lo('v1', g)} AS lo1 FROM sv)",
        f"sh AS (SELECT *, {bucket_hi('lo0', g)} AS hi0, {bucket_hi('lo1', g)} AS hi1 FROM sl)",
        f"""srows AS (
      SELECT 'salary_floor' AS metric, '' AS dim, {label('lo0', 'hi0')} AS key FROM sh WHERE {keep(True, 'lo0', 'hi0')}
      UNION ALL SELECT 'salary_ceiling', '', {label('lo1', 'hi1')} FROM sh WHERE {keep(True, 'lo1', 'hi1')}
      UNION ALL SELECT 'skills', '', token FROM tok WHERE token IN (SELECT word FROM dict)
      UNION ALL SELECT 'other', dim, value FROM ({dims_union(2, 'n_fields = 11')}) d
    )""",
    ]
    return ctes


def stream_json_ctes(job: str) -> list[str]:
    sections = {
        "salary_floor": schema.SECTION_SALARY_FLOOR,
        "salary_ceiling": schema.SECTION_SALARY_CEILING,
        "skills": schema.SECTION_SKILLS,
        "other": schema.SECTION_OTHER,
    }
    sec = "CASE metric " + " ".join(f"WHEN '{m}' THEN '{s}'" for m, s in sections.items()) + " END"
    return [
        "tot AS (SELECT metric, dim, key, CAST(count(*) AS BIGINT) AS n FROM srows GROUP BY metric, dim, key)",
        f"flat AS (SELECT metric, '{{\"' || {sec} || '\":' || {json_agg()} || '}}' AS doc FROM tot "
        "WHERE metric <> 'other' GROUP BY metric)",
        f"od AS (SELECT metric, dim, {json_agg()} AS j FROM tot WHERE metric = 'other' GROUP BY metric, dim)",
        "other AS (SELECT metric, '{' || string_agg('\"' || dim || '\":' || j, ',' ORDER BY dim) || '}' AS doc "
        "FROM od GROUP BY metric)",
        f"docs AS (SELECT '{job}:' || {sec} AS key, "
        f"'{{\"{job}\":\"' || replace(replace(doc, '\\', '\\\\'), '\"', '\\\"') || '\"}}' AS value "
        "FROM (SELECT * FROM flat UNION ALL SELECT * FROM other) x)",
    ]


# ---------------------------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------------------------


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    sg, bg = schema.STREAM_GRID, schema.BATCH_GRID

    q["postings_parse"] = _with() + (
        "SELECT id, n_fields, salary, address, company_type, company_size, experience, education, skills "
        "FROM postings"
    )

    q["field_count_gates"] = _with() + """
    SELECT gate, n FROM (
      SELECT 'ge5' AS gate, CAST(count(*) FILTER (WHERE n_fields >= 5) AS BIGINT) AS n FROM postings
      UNION ALL SELECT 'ge10', CAST(count(*) FILTER (WHERE n_fields >= 10) AS BIGINT) FROM postings
      UNION ALL SELECT 'eq11', CAST(count(*) FILTER (WHERE n_fields = 11) AS BIGINT) FROM postings
      UNION ALL SELECT 'gt10', CAST(count(*) FILTER (WHERE n_fields > 10) AS BIGINT) FROM postings
      UNION ALL SELECT 'all', CAST(count(*) AS BIGINT) FROM postings
    )"""

    q["salary_bucket_assign"] = _with(
        f"v AS (SELECT id, salary, {salary_value(0)} AS f, {salary_value(1)} AS c FROM postings)",
        f"l AS (SELECT id, salary, {bucket_lo('f', sg)} AS floor_lo, {bucket_lo('c', sg)} AS ceil_lo FROM v)",
    ) + (
        f"SELECT id, salary, floor_lo, {bucket_hi('floor_lo', sg)} AS floor_hi, "
        f"ceil_lo, {bucket_hi('ceil_lo', sg)} AS ceil_hi FROM l"
    )

    q["salary_histogram_ceil"] = histogram_sql("n_fields = 11", schema.CEILING, bg)
    q["salary_histogram_floor"] = histogram_sql("n_fields = 11", schema.FLOOR, bg)

    q["salary_cohort_histogram"] = _with(
        f"v AS (SELECT 0 AS side, {salary_value(0)} AS v FROM postings WHERE n_fields = 11 AND {COHORT} "
        f"UNION ALL SELECT 1, {salary_value(1)} FROM postings WHERE n_fields = 11 AND {COHORT})",
        f"l AS (SELECT side, {bucket_lo('v', bg)} AS lo FROM v)",
        f"h AS (SELECT side, lo, {bucket_hi('lo', bg)} AS hi FROM l)",
    ) + (
        f"SELECT side, {label()} AS bucket, lo, hi, CAST(count(*) AS BIGINT) AS n FROM h "
        f"WHERE {keep(False)} GROUP BY side, lo, hi"
    )

    from postlens.plans.registry import EDGES

    edges = "[" + ", ".join(str(e) for e in EDGES) + "]"
    q["salary_histogram_edges"] = _with(
        f"v AS (SELECT CAST({salary_value(1)} AS BIGINT) AS v FROM postings WHERE n_fields = 11)",
        f"i AS (SELECT len(list_filter({edges}, lambda e: e <= v)) AS idx FROM v WHERE v IS NOT NULL)",
        f"lh AS (SELECT CAST({edges}[idx] AS INTEGER) AS lo, CAST({edges}[idx + 1] AS INTEGER) AS hi "
        f"FROM i WHERE idx >= 1 AND idx < {len(EDGES)})",
    ) + f"SELECT {label()} AS bucket, lo, hi, CAST(count(*) AS BIGINT) AS n FROM lh GROUP BY lo, hi"

    q["salary_bucket_range_join"] = _with(
        f"v AS (SELECT {salary_value(1)} AS v FROM postings WHERE n_fields = 11)",
        "w AS (SELECT s_name, CAST(abs(floor(s_acctbal)) AS BIGINT) AS lo, CAST(abs(floor(s_acctbal)) AS BIGINT) + s_suppkey * 37 % 5000 AS hi FROM supplier)",
    ) + "SELECT s_name, lo, hi, CAST(count(*) AS BIGINT) AS n FROM w JOIN v ON v >= lo AND v < hi GROUP BY ALL"

    q["salary_grid"] = _with(
        f"v AS (SELECT {salary_value(0)} AS v FROM postings WHERE n_fields = 11)",
        "g AS (SELECT CAST(lo AS INTEGER) AS lo, CAST(least(lo + 7000, 90000) AS INTEGER) AS hi FROM range(0, 90000, 7000) r(lo))",
    ) + f"SELECT {label()} AS bucket, lo, hi, CAST(count(v) AS BIGINT) AS n FROM g LEFT JOIN v ON v >= lo AND v < hi GROUP BY lo, hi"

    q["salary_report"] = _with(
        f"v AS (SELECT ({COHORT}) AS c, {salary_value(1)} AS v FROM postings WHERE n_fields = 11)",
        f"l AS (SELECT c, {bucket_lo('v', bg)} AS lo FROM v)",
        f"h AS (SELECT c, lo, {bucket_hi('lo', bg)} AS hi FROM l)",
        f"k AS (SELECT c, CASE WHEN {keep(False)} THEN {label()} END AS key FROM h)",
        "r AS (SELECT 'salary_1' AS qualifier, key FROM k UNION ALL SELECT 'salary3_1', CASE WHEN c THEN key END FROM k)",
    ) + "SELECT qualifier, key, CAST(count(*) AS BIGINT) AS n FROM r WHERE key IS NOT NULL GROUP BY qualifier, key"

    dim_counts = (
        f"dc AS (SELECT dim, value, CAST(count(*) AS BIGINT) AS n FROM ("
        f"{dims_union(1, 'n_fields >= 10')}) u GROUP BY dim, value)"
    )
    q["dimension_counts"] = _with(dim_counts) + "SELECT dim, value, n FROM dc"
    q["dimension_labels"] = _with(
        f"dc AS (SELECT dim AS label, value, CAST(count(*) AS BIGINT) AS n FROM ("
        f"{dims_union(2, 'n_fields >= 10')}) u GROUP BY dim, value)"
    ) + "SELECT label, value, n FROM dc"
    q["dimension_json"] = _with(dim_counts) + f"SELECT dim, {json_agg('value')} AS json FROM dc GROUP BY dim"
    q["dimension_rank"] = _with(dim_counts) + (
        "SELECT dim, value, n, CAST(row_number() OVER (PARTITION BY dim ORDER BY n DESC, value) AS BIGINT) AS rnk FROM dc"
    )

    q["skill_keyword_count"] = _with(*keyword_tokens_cte("n_fields = 11")) + (
        "SELECT token, CAST(count(*) AS BIGINT) AS n FROM tok WHERE token IN (SELECT word FROM dict) GROUP BY token"
    )

    def word_count(src: str) -> str:
        return (
            f"wc AS (SELECT token, CAST(count(*) AS BIGINT) AS n FROM ("
            f"SELECT unnest({word_split('txt')}) AS token FROM ({src}) s"
            f") t WHERE token NOT IN ({STOP_SQL}) GROUP BY token)"
        )

    ranked = "SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) AS BIGINT) AS rnk FROM wc"
    q["skills_word_count"] = _with(word_count("SELECT skills AS txt FROM postings WHERE n_fields > 10")) + ranked
    q["document_word_count"] = "WITH " + word_count("SELECT text AS txt FROM documents") + "\n" + ranked

    report = _with(*report_rows_sql(), "rep AS (SELECT section, key, CAST(count(*) AS BIGINT) AS n FROM rows GROUP BY section, key)")
    q["full_report"] = report + "SELECT section, key, n FROM rep"
    q["full_report_cells"] = report + (
        f"SELECT 'postings' AS row_key, 'info' AS family, section AS qualifier, {json_agg()} AS value, "
        "CAST(0 AS BIGINT) AS version FROM rep GROUP BY section"
    )

    q["source_file_key"] = _with(*keyed_report("'part=' || CAST(id % 3 AS VARCHAR)")) + CELLS_SQL
    q["job_cells"] = _with(*keyed_report("'postings'")) + CELLS_SQL
    q["tab_word_count"] = _with(word_count("SELECT skills AS txt FROM postings WHERE n_fields > 10")) + "SELECT token, n FROM wc"

    from postlens.plans.registry import USER_WORDS

    q["user_dictionary_count"] = _with(
        f"dict(word) AS (VALUES {sql_list(sorted({w.lower() for w in USER_WORDS}))})",
        "kt AS (SELECT lower(skills) AS t FROM postings WHERE n_fields = 11 UNION ALL SELECT lower(text) FROM documents)",
        f"tok AS ({found_words('kt')})",
    ) + "SELECT token, CAST(count(*) AS BIGINT) AS n FROM tok GROUP BY token"
    q["document_term_count"] = r"""
    WITH names AS (
      SELECT lower(text) AS t FROM benchmark UNION ALL SELECT lower(c_mktsegment) FROM customer
    ), terms AS (
      SELECT DISTINCT unnest(list_filter(string_split_regex(t, '[^a-z]+'), lambda w: w <> '')) AS token FROM names
    ), used AS (
      SELECT unnest(string_split_regex(lower(text), '[^a-z]+')) AS token FROM documents
    )
    SELECT token, CAST(count(*) AS BIGINT) AS n FROM used WHERE token IN (FROM terms) GROUP BY token"""
    from postlens.operators import segment
    from postlens.plans.registry import HAN_LETTERS, LETTERS

    han = [
        f"ht AS (SELECT lower(skills) AS t FROM postings WHERE n_fields = 11 UNION ALL SELECT translate(lower(text), '{LETTERS} ', '{HAN_LETTERS}') FROM documents)",
        "runs AS MATERIALIZED (SELECT row_number() OVER () AS id, * FROM (SELECT run, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(list_filter(string_split_regex(t, '[^\\p{Han}]+'), lambda w: w <> '')) AS run FROM ht) r GROUP BY run))",
        "places AS (SELECT id, run, n, unnest(range(1, length(run) + 1)) AS pos FROM runs)",
        f"pieces AS MATERIALIZED (SELECT id, n, pos, k, substring(run, pos, k) AS gram FROM places, range(1, {segment.LONGEST + 2}) ks(k) WHERE pos + k - 1 <= length(run))",
        "grams AS (SELECT gram, CAST(sum(n) AS BIGINT) AS n FROM pieces GROUP BY gram)",
        "tot AS (SELECT CAST(sum(n * length(run)) AS DOUBLE) AS total FROM runs)",
        "lefts AS (SELECT substring(gram, 2) AS word, sum(n * ln(n)) AS w FROM grams WHERE length(gram) > 1 GROUP BY ALL)",
        "rights AS (SELECT left(gram, -1) AS word, sum(n * ln(n)) AS w FROM grams WHERE length(gram) > 1 GROUP BY ALL)",
        f"cand AS (SELECT gram AS word, n FROM grams WHERE length(gram) BETWEEN 2 AND {segment.LONGEST} AND n >= {segment.MIN_COUNT})",
        "apart AS (SELECT word, max(ln(a.n) + ln(b.n)) AS w FROM (SELECT word, unnest(range(1, length(word))) AS k FROM cand) c JOIN grams a ON a.gram = left(word, k) JOIN grams b ON b.gram = substring(word, k + 1) GROUP BY word)",
        """stat AS (SELECT word, n, CAST(round((ln(n) + ln(total) - apart.w) * 1000) AS BIGINT) AS cohesion,
            CAST(round((ln(n) - coalesce(lefts.w, 0) / n) * 1000) AS BIGINT) AS "left", CAST(round((ln(n) - coalesce(rights.w, 0) / n) * 1000) AS BIGINT) AS "right"
            FROM cand JOIN apart USING (word) LEFT JOIN lefts USING (word) LEFT JOIN rights USING (word), tot)""",
    ]
    q["han_word_statistics"] = _with(*han) + 'SELECT word, n, cohesion, "left", "right" FROM stat'
    own = sql_list(sorted({w.lower() for w in USER_WORDS}))
    q["han_word_count"] = _with(
        *han,
        f"own(word) AS (SELECT * FROM (VALUES {own}) v(word) WHERE regexp_full_match(word, '\\p{{Han}}{{2,}}'))",
        f"""lex AS MATERIALIZED (SELECT word, CAST(round((ln(total) - ln(n)) * 1000) AS BIGINT) AS cost FROM (
            SELECT word, n FROM stat WHERE cohesion >= {segment.MIN_COHESION} AND "left" >= {segment.MIN_FREEDOM} AND "right" >= {segment.MIN_FREEDOM} AND word NOT IN (FROM own)
            UNION ALL SELECT gram, n FROM grams WHERE length(gram) = 1 AND n > 1
            UNION ALL SELECT word, CASE WHEN n > 1 THEN n ELSE 1 END FROM own LEFT JOIN grams ON gram = word) w, tot)""",
        # w1 .. w4: the cost of the word of that length which ends at a place.
        """ends AS MATERIALIZED (SELECT id, pos + k - 1 AS pos, max(CASE WHEN k = 1 THEN coalesce(cost, CAST(round(ln(total) * 1000) AS BIGINT)) END) AS w1,
            max(CASE WHEN k = 2 THEN cost END) AS w2, max(CASE WHEN k = 3 THEN cost END) AS w3, max(CASE WHEN k = 4 THEN cost END) AS w4
            FROM pieces LEFT JOIN lex ON word = gram, tot WHERE k <= 4 GROUP BY ALL)""",
        # The best ways to the last four places: cost with leading zeros, then 9 less each length, so that the least text wins.
        """ways AS (
            SELECT id, CAST(0 AS BIGINT) AS pos, repeat('0', 12) AS a, CAST(NULL AS VARCHAR) AS b, CAST(NULL AS VARCHAR) AS c, CAST(NULL AS VARCHAR) AS d FROM runs
            UNION ALL
            SELECT w.id, e.pos, least(
                lpad(CAST(CAST(left(a, 12) AS BIGINT) + w1 AS VARCHAR), 12, '0') || a[13:] || '8',
                lpad(CAST(CAST(left(b, 12) AS BIGINT) + w2 AS VARCHAR), 12, '0') || b[13:] || '7',
                lpad(CAST(CAST(left(c, 12) AS BIGINT) + w3 AS VARCHAR), 12, '0') || c[13:] || '6',
                lpad(CAST(CAST(left(d, 12) AS BIGINT) + w4 AS VARCHAR), 12, '0') || d[13:] || '5'), a, b, c
            FROM ways w JOIN ends e ON e.id = w.id AND e.pos = w.pos + 1)""",
        "done AS (SELECT run, n, a[13:] AS path FROM ways JOIN runs USING (id) WHERE pos = length(run))",
        "steps AS (SELECT run, n, i, 9 - CAST(path[i] AS BIGINT) AS k, sum(9 - CAST(path[i] AS BIGINT)) OVER (PARTITION BY run ORDER BY i) AS upto FROM done, unnest(range(1, length(path) + 1)) u(i))",
        "words AS (SELECT substring(run, CAST(upto - k + 1 AS BIGINT), k) AS token, n FROM steps UNION ALL SELECT unnest(list_filter(string_split_regex(t, '[^\\p{L}\\p{N}]+|\\p{Han}+'), lambda w: w <> '')), 1 FROM ht)",
    ).replace("WITH ", "WITH RECURSIVE ", 1) + f"SELECT token, CAST(sum(n) AS BIGINT) AS n FROM words WHERE token NOT IN ({STOP_SQL}) GROUP BY token"

    q["dimension_files"] = q["dimension_counts"]

    cells = (
        "cells AS (SELECT CAST(user_id AS VARCHAR) AS row_key, 'info' AS family, event_type AS qualifier, "
        "props AS value, event_id AS version FROM events)"
    )
    latest = (
        "lat AS (SELECT row_key, family, qualifier, arg_max(value, version) AS value, max(version) AS version "
        "FROM cells GROUP BY row_key, family, qualifier)"
    )
    q["cell_store_latest"] = f"WITH {cells}, {latest} SELECT row_key, family, qualifier, value, version FROM lat"
    q["cell_store_compacted"] = q["cell_store_latest"]
    newest = "SELECT row_key, family, qualifier, value, version"
    q["cell_store_scan"] = f"WITH {cells}, {latest} {newest}, 'range' AS scan FROM lat WHERE row_key >= '2' AND row_key < '37' UNION ALL {newest}, 'prefix' FROM lat WHERE starts_with(row_key, '19')"
    q["cell_store_pivot"] = f"WITH {cells}, {latest} " + (
        "SELECT row_key, "
        "arg_max(value, version) FILTER (WHERE qualifier = 'click') AS click, "
        "arg_max(value, version) FILTER (WHERE qualifier = 'error') AS error, "
        "arg_max(value, version) FILTER (WHERE qualifier = 'purchase') AS purchase, "
        "arg_max(value, version) FILTER (WHERE qualifier = 'signup') AS signup, "
        "arg_max(value, version) FILTER (WHERE qualifier = 'view') AS view "
        "FROM lat GROUP BY row_key"
    )
    q["cell_store_text"] = f"WITH {cells}, {latest} " + (
        "SELECT row_key, string_agg(qualifier || ':' || value, chr(9) ORDER BY qualifier, value) AS text "
        "FROM lat GROUP BY row_key"
    )
    q["result_store_keys"] = f"WITH {cells} SELECT DISTINCT row_key FROM cells WHERE row_key LIKE '_1%'"

    q["common_owner_lookup"] = """
    WITH wanted AS (SELECT DISTINCT l_partkey AS part, l_suppkey AS supplier FROM lineitem),
    p AS (SELECT DISTINCT l_partkey AS part, l_orderkey FROM lineitem),
    s AS (SELECT DISTINCT l_suppkey AS supplier, l_orderkey FROM lineitem)
    SELECT CAST(part AS BIGINT) AS part, CAST(supplier AS BIGINT) AS supplier, l_orderkey FROM wanted JOIN p USING (part) JOIN s USING (supplier, l_orderkey)"""
    q["common_members"] = """
    SELECT c_mktsegment AS a, o_orderstatus AS b, CAST(o_orderkey AS VARCHAR) AS owner
    FROM orders JOIN customer ON o_custkey = c_custkey"""
    q["frequent_supplier_pairs"] = """
    WITH l AS (SELECT DISTINCT CAST(l_suppkey AS BIGINT) AS m, o_custkey AS o FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT x.m AS a, y.m AS b, CAST(count(*) AS BIGINT) AS n FROM l x JOIN l y ON x.o = y.o AND x.m < y.m GROUP BY ALL HAVING count(*) >= 40"""
    q["co_purchased_parts"] = """
    WITH l AS (SELECT DISTINCT CAST(l_partkey AS BIGINT) AS m, l_orderkey AS o FROM lineitem)
    SELECT x.m AS a, y.m AS b, CAST(count(*) AS BIGINT) AS n FROM l x JOIN l y ON x.o = y.o AND x.m < y.m GROUP BY ALL HAVING count(*) >= 2"""

    stream = stream_ctes()
    total = "SELECT metric, dim, key, CAST(count(*) AS BIGINT) AS n FROM srows WHERE metric = '{m}' GROUP BY metric, dim, key"
    q["stream_salary_floor"] = _with(*stream) + total.format(m="salary_floor")
    q["stream_salary_ceil"] = _with(*stream) + total.format(m="salary_ceiling")
    q["stream_skill_counts"] = _with(*stream) + total.format(m="skills")
    q["stream_dimension_counts"] = _with(*stream) + total.format(m="other")
    q["stream_report"] = _with(*stream) + "SELECT metric, dim, key, CAST(count(*) AS BIGINT) AS n FROM srows GROUP BY metric, dim, key"
    q["stream_report_json"] = _with(*stream, *stream_json_ctes("job")) + "SELECT key, value FROM docs"

    q["stream_json_store"] = q["stream_report_json"]
    q["stream_json_incremental"] = q["stream_report_json"]
    q["stream_state_rebuild"] = q["stream_report"]
    named = f"CASE metric WHEN 'salary_floor' THEN '{schema.SECTION_SALARY_FLOOR}' WHEN 'salary_ceiling' THEN '{schema.SECTION_SALARY_CEILING}' WHEN 'skills' THEN '{schema.SECTION_SKILLS}' ELSE '{schema.SECTION_OTHER}' END"
    q["stream_documents_read"] = _with(*stream) + f"SELECT 'job' AS job, {named} AS section, dim, key, CAST(count(*) AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS broken FROM srows GROUP BY ALL"
    q["stream_restart"] = q["stream_report"]
    return q
