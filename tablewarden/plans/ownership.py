"""Ownership rules over the folders that pages stand for."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewarden.operators import rules
from tablewarden.operators.rules import Rule
from tablewarden.plans.derived import frame, table, with_inputs

RULES = [
    Rule("*", ("@platform-team",)),
    Rule("apps/finance-*/", ("@finance-team",)),
    Rule("apps/supplier-*/", ("@supplier-team",)),
    Rule("libs/", ("@library-team",)),
    Rule("libs/finance-th*", ("@finance-team", "@library-team")),
    Rule("dbt/**/", ("@analytics-team",)),
    Rule("dbt/thth??", ("@security",)),
    Rule("apps/[st]*", ("@apps-team",)),
    Rule("apps/thther/", ("@thther-team",)),
    Rule("apps/no-such-app/", ("@nobody",)),
]
EXPLICIT = RULES[1:3] + RULES[4:]


def folders(spark, d):
    return frame(spark, d, "folders")


def parse_rules(spark, d):
    found = rules.parse_rules(frame(spark, d, "rule_lines"), inline_comments=True)
    return found.select("ord", "pattern", F.array_join("owners", " ").alias("owners"))


def flatten_distinct(spark, d):
    return rules.flatten_distinct(rules.parse_rules(frame(spark, d, "rule_lines"), True))


def last_match(spark, d):
    found = rules.last_match(folders(spark, d), "path", RULES)
    return found.select(
        "page_id", "path", "pattern", F.array_join("owners", " ").alias("owners")
    )


def last_match_table(spark, d):
    """About as many rules as pages: joined on the folder each starts in, not inlined."""
    lines = rules.parse_rules(frame(spark, d, "rule_lines"), inline_comments=True)
    table_rules = lines.select("ord", F.regexp_replace("pattern", "^/", "").alias("pattern"), "owners")
    paths = frame(spark, d, "sites").select(
        "page_id", F.concat("lang", F.lit("/"), "label", F.lit("/"), "page_id").alias("path")
    )
    found = rules.last_match(paths, "path", table_rules, max_inline=20)
    return found.select("page_id", "pattern", F.array_join("owners", " ").alias("owners"))


def has_explicit_rule(spark, d):
    flagged = rules.flag_explicit(folders(spark, d), "path", EXPLICIT, "explicit")
    return flagged.select("page_id", "explicit")


def uncovered(spark, d):
    return rules.uncovered(folders(spark, d), "path", EXPLICIT, rules.LENIENT).select("page_id", "path")


def uncovered_strict(spark, d):
    return rules.uncovered(folders(spark, d), "path", EXPLICIT).select("page_id", "path")


def uncovered_table(spark, d):
    """The same with rules from a table, joined instead of inlined."""
    rows = [(i, r.pattern, list(r.owners)) for i, r in enumerate(EXPLICIT)]
    listed = spark.createDataFrame(rows, "ord int, pattern string, owners array<string>")
    found = rules.uncovered(folders(spark, d), "path", listed, max_inline=1)
    return found.select("page_id", "path")


def _refs(spark, d):
    return rules.mentions(table(spark, d, "pages"), '<a href="/[^"]+"', "url", "html")


def _declared(spark, d):
    french = frame(spark, d, "sites").filter("lang IN ('fr', 'es')")
    seen = rules.mentions(french, '<a href="/[^"]+"', "url", "html").select("name").distinct()
    sources = table(spark, d, "documents").select("source").distinct()
    return seen.unionByName(sources.withColumnRenamed("source", "name"))


def reference_check(spark, d):
    return rules.reference_check(_refs(spark, d), _declared(spark, d), ["src3", "src7"])


def examples(spark, d):
    items = table(spark, d, "lineitem")
    found = rules.examples(items, "l_returnflag", "l_partkey")
    return found.withColumn("position", F.col("position").cast("bigint"))


def stale_entries(spark, d):
    entries = table(spark, d, "documents").select("doc_id")
    labelled = table(spark, d, "labels")
    return rules.stale(entries, labelled, "doc_id", "documents", "document has no label")


def inventory(spark, d):
    return rules.inventory(
        {
            "in_documents": table(spark, d, "documents").select(F.col("doc_id").alias("id")),
            "in_labels": table(spark, d, "labels").select(F.col("doc_id").alias("id")),
            "in_pages": table(spark, d, "pages").select(F.col("page_id").alias("id")),
            "in_talks": table(spark, d, "conversations").select(F.col("conv_id").alias("id")),
        },
        "id",
    )


def status(spark, d):
    """Folders by page; catalogued when an unsubdomained page has it, guided when a blog has."""
    paths = folders(spark, d).join(frame(spark, d, "sites").select("page_id", "url"), "page_id")
    found = paths.filter("path NOT LIKE 'infra/%'")
    return rules.folder_status(
        found.filter("url LIKE 'https:%'").select("path"),
        found.filter("url LIKE '%.html' OR url LIKE '%/'").select("path"),
        found.filter("url LIKE '%#top'").select("path"),
        RULES,
    )


def folder_status(spark, d):
    return status(spark, d).select(
        "path", "folder_exists", "in_rules", "in_catalogue", "has_guide", "pattern",
        F.array_join("owners", " ").alias("owners"),
        F.size("actions").cast("bigint").alias("n_actions"),
    )


def required_actions(spark, d):
    return rules.required_actions(status(spark, d)).withColumn(
        "position", F.col("position").cast("bigint")
    )


def section_summary(spark, d):
    return rules.section_summary(status(spark, d), (*rules.SECTIONS, "docs"))


def owner_summary(spark, d):
    return rules.owner_summary(status(spark, d))


def owner_members(spark, d):
    return rules.owner_members(status(spark, d))


def overall_status(spark, d):
    found = status(spark, d)
    missing = found.filter("NOT folder_exists").select("path")
    entries = rules.stale(missing, found.filter("folder_exists"), "path", "catalogue", "no folder")
    return rules.overall_status(found, entries)


QUERIES = {
    "parse_rules": parse_rules,
    "flatten_distinct": flatten_distinct,
    "last_match": last_match,
    "last_match_table": last_match_table,
    "has_explicit_rule": has_explicit_rule,
    "uncovered": uncovered,
    "uncovered_strict": uncovered_strict,
    "uncovered_table": uncovered_table,
    "reference_check": reference_check,
    "examples": examples,
    "stale_entries": stale_entries,
    "inventory": inventory,
    "folder_status": folder_status,
    "required_actions": required_actions,
    "section_summary": section_summary,
    "owner_summary": owner_summary,
    "owner_members": owner_members,
    "overall_status": overall_status,
}


def _values(chosen: list[Rule]) -> str:
    rows = ", ".join(
        f"({i}, '{r.pattern}', '{' '.join(r.owners)}')" for i, r in enumerate(chosen)
    )
    return f"(VALUES {rows}) r(ord, pattern, owners)"


# An independent matcher: DuckDB's GLOB plus plain string tests.
_HIT = """({p} GLOB r.pattern OR ({p} || '/') GLOB r.pattern
    OR {p} = rtrim(r.pattern, '/*') OR starts_with({p}, rtrim(r.pattern, '/*') || '/')
    OR (r.pattern LIKE '%*' AND starts_with({p}, rtrim(r.pattern, '/*'))))"""
_GLOB = """CASE WHEN r.pattern LIKE '%/' OR contains(split_part('/' || r.pattern, '/', -1), '*')
    THEN '/' || r.pattern ELSE '/' || r.pattern || '/' END"""
_STRICT = f"""(('/' || f.path || '/') GLOB ({_GLOB}) OR ('/' || f.path || '/') GLOB ({_GLOB} || '*')
    OR ('/' || f.path) GLOB left({_GLOB}, length({_GLOB}) - 1))"""
_F = with_inputs("folders")
_LINES = """parsed AS (
    SELECT ord, string_split_regex(trim(split_part(line, '#', 1)), '[ ]+') AS words
    FROM rule_lines WHERE trim(split_part(line, '#', 1)) <> ''),
    rules AS (SELECT ord, words[1] AS pattern, array_to_string(words[2:], ' ') AS owners
              FROM parsed WHERE len(words) >= 2)"""
_STATUS = f"""known AS (
    SELECT f.path, bool_or(url LIKE 'https:%') AS folder_exists,
           bool_or(url LIKE '%.html' OR url LIKE '%/') AS in_catalogue,
           bool_or(url LIKE '%#top') AS guide
    FROM folders f JOIN sites s ON s.page_id = f.page_id
    WHERE f.path NOT LIKE 'infra/%'
    GROUP BY f.path
    UNION ALL
    SELECT v.path, FALSE, FALSE, FALSE FROM (VALUES ('apps/thther'), ('apps/no-such-app')) v(path)
    WHERE v.path NOT IN (SELECT path FROM folders)),
    relevant AS (
    SELECT path, folder_exists, in_catalogue, guide AND folder_exists AS has_guide FROM known
    WHERE folder_exists OR in_catalogue OR path IN ('apps/thther', 'apps/no-such-app')),
    owned AS (
    SELECT k.path, arg_max(r.pattern, r.ord) AS pattern, arg_max(r.owners, r.ord) AS owners,
           bool_or(r.pattern <> '*') AS in_rules
    FROM relevant k JOIN {_values(RULES)} ON {_HIT.format(p="k.path")} GROUP BY k.path),
    todo AS (
    SELECT path, 1 AS o, '{rules.CREATE_FOLDER}' AS action FROM relevant WHERE NOT folder_exists
    UNION ALL SELECT path, 2, '{rules.ASSIGN_OWNER}' FROM owned WHERE NOT in_rules
    UNION ALL SELECT path, 3, '{rules.ADD_TO_CATALOGUE}' FROM relevant
    WHERE path LIKE 'apps/%' AND NOT in_catalogue
    UNION ALL SELECT path, 4, '{rules.ADD_GUIDE}' FROM relevant
    WHERE folder_exists AND NOT has_guide),
    status AS (
    SELECT k.*, w.pattern, w.owners, w.in_rules,
           (SELECT COUNT(*) FROM todo t WHERE t.path = k.path) AS n_actions
    FROM relevant k JOIN owned w ON w.path = k.path)"""
_COUNTS = """COUNT(*) AS total, COUNT(*) FILTER (WHERE n_actions = 0) AS healthy,
    COUNT(*) FILTER (WHERE n_actions > 0) AS issues"""
_REFS = """refs AS (
    SELECT DISTINCT url, unnest(regexp_extract_all(html, '<a href="/[^"]+"')) AS name FROM sites),
    declared AS (
    SELECT DISTINCT unnest(regexp_extract_all(html, '<a href="/[^"]+"')) AS name
    FROM sites WHERE lang IN ('fr', 'es')
    UNION SELECT DISTINCT source FROM documents)"""

SQL = {
    "parse_rules": f"""{with_inputs("rule_lines")}, {_LINES}
        SELECT ord, pattern, owners FROM rules""",
    "flatten_distinct": f"""{with_inputs("rule_lines")}, {_LINES}
        SELECT DISTINCT unnest(string_split(owners, ' ')) AS owner FROM rules""",
    "last_match": f"""{_F}
        SELECT f.page_id, f.path, arg_max(r.pattern, r.ord) AS pattern,
               arg_max(r.owners, r.ord) AS owners
        FROM folders f JOIN {_values(RULES)} ON {_HIT.format(p="f.path")}
        GROUP BY f.page_id, f.path""",
    "last_match_table": f"""{with_inputs("rule_lines", "sites")}, {_LINES}, hits AS (
        SELECT s.page_id, arg_max(r.pattern, r.ord) AS pattern, arg_max(r.owners, r.ord) AS owners
        FROM (SELECT page_id, lang || '/' || label || '/' || page_id AS path FROM sites) s
        JOIN (SELECT ord, ltrim(pattern, '/') AS pattern, owners FROM rules) r
          ON {_HIT.format(p="s.path")}
        GROUP BY s.page_id)
        SELECT s.page_id, COALESCE(h.pattern, '*') AS pattern,
               COALESCE(h.owners, '@platform-team') AS owners
        FROM sites s LEFT JOIN hits h ON h.page_id = s.page_id""",
    "has_explicit_rule": f"""{_F}
        SELECT f.page_id, bool_or({_HIT.format(p="f.path")}) AS explicit
        FROM folders f CROSS JOIN {_values(EXPLICIT)} GROUP BY f.page_id""",
    "uncovered": f"""{_F}
        SELECT f.page_id, f.path FROM folders f CROSS JOIN {_values(EXPLICIT)}
        GROUP BY f.page_id, f.path HAVING NOT bool_or({_HIT.format(p="f.path")})""",
    "uncovered_strict": f"""{_F}
        SELECT f.page_id, f.path FROM folders f CROSS JOIN {_values(EXPLICIT)}
        GROUP BY f.page_id, f.path HAVING NOT bool_or({_STRICT})""",
    "uncovered_table": f"""{_F}
        SELECT f.page_id, f.path FROM folders f CROSS JOIN {_values(EXPLICIT)}
        GROUP BY f.page_id, f.path HAVING NOT bool_or({_STRICT})""",
    "reference_check": f"""{with_inputs("sites")}, {_REFS}, used AS (
        SELECT name, COUNT(*) AS n_paths,
               array_to_string(list_sort(list(url))[1:3], ', ') AS examples
        FROM refs GROUP BY name)
        SELECT u.name, u.n_paths, 'error' AS level, u.examples FROM used u
        WHERE u.name NOT IN (SELECT name FROM declared)
        UNION ALL
        SELECT d.name, 0, 'warning', '' FROM declared d
        WHERE d.name NOT IN (SELECT name FROM used) AND d.name NOT IN ('src3', 'src7')""",
    "examples": """WITH items AS (SELECT DISTINCT l_returnflag, l_partkey FROM lineitem)
        SELECT l_returnflag, l_partkey, position, n_items FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY l_returnflag ORDER BY l_partkey) AS position,
                   COUNT(*) OVER (PARTITION BY l_returnflag) AS n_items FROM items)
        WHERE position <= 3""",
    "stale_entries": """SELECT DISTINCT 'documents' AS source, doc_id AS entry,
               'document has no label' AS reason
        FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "inventory": """WITH ids AS (
            SELECT doc_id AS id FROM documents UNION SELECT doc_id FROM labels
            UNION SELECT page_id FROM pages UNION SELECT conv_id FROM conversations)
        SELECT id, id IN (SELECT doc_id FROM documents) AS in_documents,
               id IN (SELECT doc_id FROM labels) AS in_labels,
               id IN (SELECT page_id FROM pages) AS in_pages,
               id IN (SELECT conv_id FROM conversations) AS in_talks FROM ids""",
    "folder_status": f"""{_F}, {_STATUS}
        SELECT path, folder_exists, in_rules, in_catalogue, has_guide, pattern, owners, n_actions
        FROM status""",
    "required_actions": f"""{_F}, {_STATUS}
        SELECT t.path, replace(s.owners, ' ', ', ') AS owner,
               ROW_NUMBER() OVER (PARTITION BY t.path ORDER BY t.o) - 1 AS position, t.action
        FROM todo t JOIN status s ON s.path = t.path""",
    "section_summary": f"""{_F}, {_STATUS}
        SELECT COALESCE(v.section, 'TOTAL') AS section, COUNT(s.path) AS total,
               COUNT(*) FILTER (WHERE s.n_actions = 0) AS healthy,
               COUNT(*) FILTER (WHERE s.n_actions > 0) AS issues
        FROM (VALUES ('apps'), ('libs'), ('dbt'), ('docs')) v(section)
        LEFT JOIN status s ON split_part(s.path, '/', 1) = v.section
        GROUP BY ROLLUP(v.section)""",
    "owner_summary": f"""{_F}, {_STATUS}
        SELECT replace(owners, ' ', ', ') AS owner, {_COUNTS} FROM status GROUP BY owners""",
    "owner_members": f"""{_F}, {_STATUS}
        SELECT replace(owners, ' ', ', ') AS owner, path FROM status""",
    "overall_status": f"""{_F}, {_STATUS}
        SELECT COUNT(*) AS folders, COUNT(*) FILTER (WHERE n_actions > 0) AS issues,
               COUNT(*) FILTER (WHERE NOT folder_exists) AS stale,
               CASE WHEN COUNT(*) FILTER (WHERE n_actions > 0 OR NOT folder_exists) = 0
                    THEN 'PASS' ELSE 'NEEDS ATTENTION' END AS status
        FROM status""",
}
