"""Vocabularies that occur in the test tables, and SQL building blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillmesh.functions import fixed

#: name, category, domain, keywords; 45 keywords in all
TAGS = [
    ("attion deal", "Event", "Business", ["attion", "antion", "retion", "tion", "ble", "thre", "anea"]),
    ("thing series", "Event", "Business", ["thing", "thes", "thin", "thtion", "erre", "erly", "ersh"]),
    ("ering therapy", "Therapy", "Healthcare", ["ering", "erin", "oning", "erha", "eriner", "onst", "aner"]),
    ("que platform", "Entity", "Healthcare", ["que", "des", "eaux", "onea", "anen", "anth", "reed"]),
    ("und approval", "Clinical", "Healthcare", ["und", "die", "der", "anst", "par", "rent", "hend"]),
    ("ción funding", "Event", "Business", ["ción", "los", "las", "dans", "iner", "edha", "heou", "rest", "ores"]),
    ("idle", "Other", "General", ["zzzz"]),
]
VOCAB = [(name, k) for name, _, _, keywords in TAGS for k in keywords]
CATEGORIES = {name: category for name, category, _, _ in TAGS}
MEDICAL = ["thing", "therapy"]

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_fold(expr: str, patterns: list[str], to: str = "", flags: str = "gi") -> str:
    for p in patterns:
        expr = f"regexp_replace({expr}, {quote(p)}, {quote(to)}, '{flags}')"
    return expr


def sql_strip(expr: str) -> str:
    return f"trim({expr}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def sql_collapse(expr: str) -> str:
    return rf"regexp_replace({expr}, '[\s\v]+', ' ', 'g')".replace(r"\v", chr(11))


def sql_urls(expr: str) -> str:
    return rf"regexp_replace({expr}, 'https?://\S+|www\.\S+', '', 'g')"


def sql_emails(expr: str) -> str:
    return rf"regexp_replace({expr}, '\S+@\S+', '', 'g')"


def sql_single(expr: str) -> str:
    w = r"([^\p{L}\p{N}_])"
    p = rf"(^|[^\p{{L}}\p{{N}}_])[\p{{L}}\p{{N}}_]($|[^\p{{L}}\p{{N}}_])"
    del w
    return f"regexp_replace(regexp_replace({expr}, '{p}', '\\1\\2', 'g'), '{p}', '\\1\\2', 'g')"


def sql_tidy(expr: str) -> str:
    return sql_strip(rf"regexp_replace(regexp_replace({expr}, '\.{{2,}}', '.', 'g'), '\s{{3,}}', ' ', 'g')")


def sql_boilerplate(expr: str) -> str:
    return sql_tidy(sql_fold(sql_fold(sql_strip(expr), fixed.SHORT_BOILERPLATE), fixed.SHORT_MARKERS, "."))


def sql_core(expr: str) -> str:
    low = sql_emails(sql_urls(f"lower({expr})"))
    return sql_strip(sql_single(sql_collapse(rf"regexp_replace({low}, '[^\p{{L}}\p{{N}}_\s''\-]', ' ', 'g')")))


def sql_values(rows: list[tuple], columns: str) -> str:
    def cell(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, list):
            return "[" + ", ".join(map(cell, v)) + "]"
        return quote(v) if isinstance(v, str) else str(v)

    return "(VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + f") AS v({columns})"


def sql_tokens(expr: str) -> str:
    return rf"list_filter(string_split_regex({expr}, '[^\p{{L}}\p{{N}}_]+'), lambda w: w <> '')"


VOCAB_SQL = sql_values(VOCAB, "tag, keyword")
HITS_SQL = f"hits AS (SELECT doc_id, tag, keyword FROM (SELECT DISTINCT doc_id, unnest({sql_tokens('lower(coalesce(text, chr(32)))')}) AS keyword FROM documents) JOIN {VOCAB_SQL} USING (keyword))"
SOURCE_TYPE_SQL = "CASE " + " ".join(f"WHEN regexp_matches(lower(%s), {quote('|'.join(marks))}) THEN {quote(name)}" for name, marks in fixed.SOURCE_TYPES) + " ELSE 'Other' END"
