"""Building blocks of the DuckDB check queries.

Named relations are listed with what they need; ``sql`` puts the ones a query
uses in front of it as common table expressions. The rules are written here a
second time, as plain SQL over joins, so that both sides can be compared.
DuckDB's patterns know no lookaround; such rules are spelled out by position.
"""

from __future__ import annotations

import re

from regwise import rules as R
from workload.frames import FRAMES, PARENTS, TABLES

WS = "[\\s　]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def core(x: str) -> str:
    return f"regexp_replace({x}, {q(R.PLACE_SUFFIX)}, '')"


def normalize(x: str) -> str:
    undated = f"regexp_replace({strip(x)}, {q(R.DATE_PREFIX)}, '')"
    return f"regexp_replace({strip(undated)}, {q(R.SECTION)}, '')"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(pattern)})"


def first(x: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract({x}, {q(pattern)}, {group})"


def split_units(x: str) -> str:
    parts = f"list_transform(string_split_regex(coalesce({x}, ''), {q(R.UNIT_SPLIT)}), lambda p: {strip('p')})"
    return f"list_filter({parts}, lambda p: p <> '')"


LEGAL_SUFFIX = R.LEGAL_SUFFIX.replace("(?<!公)司$", "^司$|[^公]司$")
NATION = "^(中华人民共和国|国家环保|国家生态环境)|^(环境保护部|生态环境部)($|[^门])"
# 埍 and 埏 are the neighbours of 城
TOWN = "[一-龥]{1,5}?(?:[一-龥](?:镇|街道)|[一-埍埏-龥]乡)"


def role(x: str) -> str:
    return (f"CASE WHEN {has(x, R.ROLE_ECO)} OR {has(x, R.BARE_ZONE_BRANCH)} OR {has(x, R.ECO_TRUNCATED)} THEN '生态环境' "
            f"WHEN {has(x, R.ROLE_ADMIN)} THEN '行政审批' "
            f"WHEN {has(x, R.ROLE_ZONE)} OR {has(x, '^[一-龥]{0,8}' + R.ZONE + '$')} THEN '开发区管委会' ELSE '其他部门' END")


def function(x: str, words: str = "place_words") -> str:
    rest = f"regexp_replace({x}, {words}, '', 'g')"
    bare = f"regexp_replace(regexp_replace({rest}, '[（(].*?[）)]', '', 'g'), {q(R.ZONE)}, '', 'g')"
    return (f"CASE WHEN {has(x, R.ECO)} OR {has(x, R.ECO_TRUNCATED)} THEN '生态环境' "
            f"WHEN {has(x, R.ROLE_ECO)} AND {has(x, R.ADMIN)} THEN '生态环境' "
            f"WHEN {has(x, R.ADMIN)} THEN '行政审批' "
            f"WHEN {rest} = '分局' OR {has(rest, '^[一-龥]分局$')} THEN '生态环境' "
            f"WHEN {strip(bare)} = '' THEN '行政审批' ELSE {rest} END")


def irregular(x: str) -> str:
    blanks = ",".join(q(b) for b in R.BLANK_NAMES)
    return (f"({x} = '' OR {x} IN ({blanks}) OR contains({x}, '我局') OR {has(x, '[;；]')} "
            f"OR NOT {has(x, LEGAL_SUFFIX)} OR {has(x, R.COMPANY)} OR {has(x, R.TYPO)})")


def stage(x: str) -> str:
    whens = " ".join(f"WHEN {has(x, p)} THEN '{n}'" for n, p in R.STAGE_PATTERNS)
    return f"CASE {whens} ELSE '' END"


def clean_title(x: str) -> str:
    return strip(f"regexp_replace({x}, '^[\\x{{200b}}\\x{{feff}}\\s　]*(?:\\d{{4}}年\\d{{1,2}}月\\d{{1,2}}日)?', '')")


def publisher(x: str) -> str:
    return f"regexp_extract({clean_title(x)}, {q(R.PUBLISHER)}, 1)"


def bracket(x: str) -> str:
    return strip(first(x, R.BRACKET, 1))


def source(x: str) -> str:
    named = f"regexp_extract({x}, '(?:文章来源|来源)[：:][\\s　]*([^\\s　<]+)', 1)"
    return strip(f"string_split_regex({named}, {q(R.SOURCE_TAIL)})[1]")


def norm_url(x: str) -> str:
    return (f"replace(replace(replace(regexp_replace({x}, '/+$', ''), 'https://', ''), 'http://', ''), 'www.', '')")


def host(x: str) -> str:
    return f"lower(regexp_replace(string_split(string_split({x}, '//')[-1], '/')[1], '^www\\.', ''))"


def field(x: str) -> str:
    whens = " ".join(f"WHEN {x} IN ({','.join(q(s) for s in syn)}) THEN '{n}'" for n, syn in R.FIELD_SYNONYMS.items())
    return f"CASE {whens} ELSE '' END"


def is_report(label: str, size: str, pages: str) -> str:
    return (f"CASE WHEN {has(label, R.DECISION)} OR {has(label, R.SIDE_MATERIAL)} THEN false "
            f"WHEN {has(label, R.PARTICIPATION)} AND NOT {has(label, R.REPORT)} THEN false "
            f"WHEN {has(label, R.REPORT)} OR {has(label, R.NAMED_FILE)} THEN true "
            f"WHEN {size} < {R.BIG_FILE} THEN false ELSE coalesce({pages} >= {R.MIN_PAGES}, true) END")


# name -> (needs, SQL)
RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    name: (PARENTS[name], text.format(**{p: p for p in PARENTS[name]})) for name, text in FRAMES.items()
}


def relation(name: str, needs: str, text: str) -> None:
    RELATIONS[name] = (tuple(needs.split()), text)


relation("p_prov", "area", f"SELECT DISTINCT prov_code, prov_name, prov_short, {core('prov_name')} AS prov_core FROM area")
relation("p_city", "area", f"SELECT DISTINCT prov_code, city_code, city_name, city_short, city_ord, {core('city_name')} AS ccore FROM area")
relation("p_dist", "area", f"""SELECT prov_code, city_code, city_name, {core('city_name')} AS ccore, district_code, district_name, district_short,
  district_ord, {core('district_name')} AS dcore, {core('district_short')} AS dshort FROM area""")
relation("p_words", "area", f"""SELECT DISTINCT prov_code, w FROM (
  SELECT prov_code, unnest([{core('prov_name')}, {core('prov_short')}, {core('city_name')}, {core('city_short')},
  {core('district_name')}, {core('district_short')}]) AS w FROM area) WHERE w <> ''""")
relation("p_pattern", "p_words p_city p_prov", """SELECT a.prov_code, a.place_words, b.city_words, c.prov_core, c.prov_name, c.prov_short FROM
  (SELECT prov_code, '(?:' || string_agg(w, '|' ORDER BY length(w) DESC, w) || ')[省市区县]?' AS place_words FROM p_words GROUP BY 1) a
  JOIN (SELECT prov_code, string_agg(w, '|' ORDER BY length(w) DESC, w) AS city_words FROM
        (SELECT DISTINCT prov_code, ccore AS w FROM p_city UNION SELECT prov_code, prov_core FROM p_prov) GROUP BY 1) b USING (prov_code)
  JOIN p_prov c USING (prov_code)""")


def locate(out: str, src: str) -> str:
    """Relations that locate ``src(prov_code, city_code, name, county)``; returns the name of the result."""
    n = f"{out}_n"
    relation(n, src, f"SELECT DISTINCT prov_code, city_code, name, county FROM {src}")
    relation(f"{out}_named", f"{n} p_city", f"""
      SELECT n.prov_code, n.name, arg_min(c.city_code, instr(masked, c.ccore) * 1000 + c.city_ord) AS named_code
      FROM (SELECT n.prov_code, n.name, c.city_code, c.ccore, c.city_ord,
                   replace(n.name, c.ccore || '湾', repeat('#', length(c.ccore) + 1)) AS masked
            FROM (SELECT DISTINCT prov_code, name FROM {n}) n JOIN p_city c USING (prov_code)) n
      JOIN p_city c USING (prov_code, city_code) WHERE contains(masked, c.ccore) GROUP BY 1, 2""")
    rest = ("CASE WHEN starts_with(n.name, d.ccore) THEN regexp_replace(substr(n.name, length(d.ccore) + 1), '^市', '') "
            "ELSE n.name END")
    relation(f"{out}_hits", f"{n} p_dist", f"""
      SELECT prov_code, name, city_code, city_name, arg_min(dcore, district_ord - length(district_name) * 1000) AS dcore
      FROM (SELECT n.prov_code, n.name, d.city_code, d.city_name, d.dcore, d.district_ord, d.district_name, {rest} AS rest
            FROM (SELECT DISTINCT prov_code, name FROM {n}) n JOIN p_dist d USING (prov_code))
      WHERE CASE WHEN length(dcore) = 1 THEN contains(rest, dcore || '县') OR contains(rest, dcore || '区') OR contains(rest, dcore || '市')
            ELSE contains(rest, dcore) END GROUP BY 1, 2, 3, 4""")
    relation(f"{out}_uniq", f"{out}_hits", f"""
      SELECT prov_code, name, min(city_code) AS u_code, min(city_name) AS u_city, min(dcore) AS u_core FROM {out}_hits
      GROUP BY 1, 2 HAVING count(*) = 1""")
    relation(f"{out}_zone", f"{n} p_pattern", f"""
      SELECT prov_code, name, county, word,
        CASE WHEN prov_code = '340000' AND contains(name, '毛集实验区') THEN '毛集实验区'
             WHEN word = '' THEN NULL
             WHEN length(head) > 1 THEN head || kind
             WHEN raw_head <> '' AND head = '' AND NOT leftover THEN '本级' || kind
             ELSE coalesce(nullif({core('county')}, ''), nullif(head, ''), '本级') || kind END AS zone
      FROM (SELECT *, CASE {' '.join(f"WHEN word = '{w}' THEN '{k}'" for w, k in R.ZONE_KIND.items())} END AS kind,
              regexp_replace(regexp_replace(regexp_replace(CASE WHEN leftover THEN '' ELSE tail END, city_words, '', 'g'),
                             '^[省市]+', ''), '[市区县]$', '') AS head
            FROM (SELECT *, length(tail) = 1 AND tail <> raw_head AS leftover
                  FROM (SELECT n.*, p.city_words, {first('n.name', R.ZONE, 2)} AS word, {first('n.name', R.ZONE, 1)} AS raw_head,
                               regexp_replace({first('n.name', R.ZONE, 1)}, '^.*{R.AGENCY_CHARS}', '') AS tail
                        FROM (SELECT DISTINCT prov_code, name, county FROM {n}) n JOIN p_pattern p USING (prov_code))))""")
    relation(f"{out}_city", f"{n} {out}_named {out}_uniq p_city", f"""
      SELECT n.*, named_code, u_code, u_city, u_core,
        CASE WHEN coalesce(named_code, c.city_code) IS NULL THEN NULL
             WHEN named_code IS NULL AND u_code IS NOT NULL AND u_code <> c.city_code THEN u_code
             ELSE coalesce(named_code, c.city_code) END AS at_code
      FROM {n} n LEFT JOIN {out}_named USING (prov_code, name) LEFT JOIN {out}_uniq USING (prov_code, name)
      LEFT JOIN p_city c ON c.prov_code = n.prov_code AND c.city_code = n.city_code""")
    relation(out, f"{out}_city {out}_hits {out}_zone p_city p_dist p_pattern", f"""
      SELECT l.prov_code, l.city_code, l.name, l.county, l.place_words,
        CASE WHEN l.k IN (1, 7) THEN '—' WHEN l.k = 4 THEN l.u_city WHEN l.k = 0 THEN NULL ELSE l.city_name END AS city,
        CASE l.k WHEN 1 THEN '国家' WHEN 2 THEN l.zone WHEN 3 THEN l.dcore WHEN 4 THEN l.u_core WHEN 5 THEN '市本级'
          WHEN 7 THEN '省级' WHEN 8 THEN '市本级' WHEN 9 THEN l.town WHEN 10 THEN l.county_core END AS area
      FROM (SELECT a.*, c.city_name, h.dcore, z.zone, p.place_words, {first('a.name', TOWN)} AS town, {core('a.county')} AS county_core,
        CASE WHEN {has('a.name', NATION)} THEN 1 WHEN a.at_code IS NULL THEN 0 WHEN z.zone IS NOT NULL THEN 2
             WHEN h.dcore IS NOT NULL THEN 3 WHEN a.u_core IS NOT NULL THEN 4 WHEN a.named_code IS NOT NULL THEN 5
             WHEN contains(a.name, p.prov_core) THEN 7 WHEN contains(a.name, c.ccore) THEN 8
             WHEN {first('a.name', TOWN)} <> '' THEN 9
             WHEN {has('a.name', R.WINDOW)} AND a.county <> '' AND EXISTS (SELECT 1 FROM p_dist d WHERE d.city_code = a.at_code
                  AND ({core('a.county')} = d.dcore OR {core('a.county')} = d.dshort)) THEN 10
             ELSE 0 END AS k
        FROM {out}_city a JOIN p_pattern p USING (prov_code)
        LEFT JOIN p_city c ON c.city_code = a.at_code
        LEFT JOIN {out}_hits h ON h.prov_code = a.prov_code AND h.name = a.name AND h.city_code = a.at_code
        LEFT JOIN {out}_zone z ON z.prov_code = a.prov_code AND z.name = a.name AND z.county IS NOT DISTINCT FROM a.county) l""")
    return out


def clean_up(tag: str, rows: str, listed: str = "") -> None:
    """Relations of the whole clean-up over ``rows(prov_code, city_code, raw, notice_date, county, ord, part)``.

    ``listed`` names a relation (prov_code, name) of spellings known to be misplaced.
    """
    relation(f"{tag}_norm", rows, f"SELECT *, {normalize('raw')} AS name FROM {rows}")
    relation(f"{tag}_spell", f"{tag}_norm", f"""
      SELECT s.*, coalesce(m.county, '') AS county FROM
        (SELECT prov_code, city_code, name, count(*) AS n, coalesce(max(notice_date), '') AS last_date, min(ord * 10 + part) AS ord
         FROM {tag}_norm WHERE name <> '' GROUP BY 1, 2, 3) s
      LEFT JOIN (SELECT prov_code, city_code, name, county FROM
        (SELECT prov_code, city_code, name, county, count(*) AS c, min(ord * 10 + part) AS o FROM {tag}_norm WHERE county <> '' GROUP BY 1, 2, 3, 4)
        QUALIFY row_number() OVER (PARTITION BY prov_code, city_code, name ORDER BY c DESC, o) = 1) m USING (prov_code, city_code, name)""")
    locate(f"{tag}_loc", f"{tag}_spell")
    curated = f" OR (s.prov_code, s.name) IN (SELECT prov_code, name FROM {listed})" if listed else ""
    relation(f"{tag}_judged", f"{tag}_spell {tag}_loc p_words {listed}".strip(), f"""
      SELECT s.*, l.city, l.area, {function('s.name', 'l.place_words')} AS function,
        CASE WHEN (x.prefix <> '' AND w.w IS NULL){curated} THEN '标错地区'
             WHEN {irregular('s.name')} OR l.area IS NULL THEN '不规范' END AS drop_reason
      FROM {tag}_spell s JOIN {tag}_loc l USING (prov_code, city_code, name, county)
      JOIN (SELECT DISTINCT prov_code, name, {first("regexp_replace(name, '^驻', '')", R.PLACE_PREFIX, 1)} AS prefix FROM {tag}_spell) x USING (prov_code, name)
      LEFT JOIN p_words w ON w.prov_code = s.prov_code AND w.w = {core('x.prefix')}""")
    kinds = sorted(set(R.ZONE_KIND.values()), key=lambda k: (-len(k), k))
    kind = "CASE " + " ".join(f"WHEN ends_with(area, '{k}') THEN '{k}'" for k in kinds) + " END"
    relation(f"{tag}_zones", f"{tag}_judged", f"""
      SELECT *, substr(area, 1, length(area) - length(kind)) AS head FROM
        (SELECT prov_code, city, area, {kind} AS kind, sum(n) AS n FROM {tag}_judged WHERE drop_reason IS NULL GROUP BY 1, 2, 3)
      WHERE kind IS NOT NULL""")
    relation(f"{tag}_canon", f"{tag}_zones", f"""
      SELECT a.prov_code, a.city, a.area, min(b.area) AS canonical FROM {tag}_zones a JOIN {tag}_zones b
        ON a.prov_code = b.prov_code AND a.city = b.city AND a.kind = b.kind AND a.head <> b.head AND b.n > a.n
        AND (contains(a.head, b.head) OR contains(b.head, a.head))
      WHERE a.head NOT IN ('', '本级') AND b.head NOT IN ('', '本级') GROUP BY 1, 2, 3 HAVING count(*) = 1""")
    relation(f"{tag}_kept", f"{tag}_judged {tag}_canon", f"""
      SELECT j.* EXCLUDE (area, drop_reason), coalesce(c.canonical, j.area) AS area FROM {tag}_judged j
      LEFT JOIN {tag}_canon c USING (prov_code, city, area) WHERE j.drop_reason IS NULL""")
    relation(f"{tag}_found", f"{tag}_judged {tag}_kept", f"""
      SELECT d.prov_code, d.city_code, d.name, min(k.city) AS city, min(k.area) AS area, min(k.function) AS function
      FROM {tag}_judged d JOIN {tag}_kept k ON d.prov_code = k.prov_code AND d.city_code = k.city_code AND d.county = k.county
        AND (starts_with(k.name, d.name) OR ends_with(k.name, d.name))
      WHERE d.drop_reason IS NOT NULL AND length(d.name) >= 3 AND d.county <> '' AND {has('d.name', R.TRUNCATABLE)}
      GROUP BY 1, 2, 3 HAVING count(DISTINCT (k.city, k.area, k.function)) = 1""")
    relation(f"{tag}_all", f"{tag}_kept {tag}_found {tag}_judged", f"""
      SELECT prov_code, city_code, name, n, last_date, ord, city, area, function, 0 AS recovered FROM {tag}_kept
      UNION ALL SELECT j.prov_code, j.city_code, j.name, j.n, j.last_date, j.ord, f.city, f.area, f.function, 1
      FROM {tag}_judged j JOIN {tag}_found f USING (prov_code, city_code, name)""")
    relation(f"{tag}_dropped", f"{tag}_judged {tag}_found", f"""
      SELECT j.* FROM {tag}_judged j ANTI JOIN {tag}_found f USING (prov_code, city_code, name) WHERE j.drop_reason IS NOT NULL""")
    relation(f"{tag}_ranked", f"{tag}_all", f"""
      SELECT *, row_number() OVER (PARTITION BY prov_code, city, area, function
        ORDER BY {has('name', R.PROPER_SUFFIX)} DESC, last_date DESC, n DESC, length(name) DESC, recovered, ord) AS rk FROM {tag}_all""")
    relation(f"{tag}_units", f"{tag}_ranked {tag}_all", f"""
      SELECT prov_code, city, area, function, unit, CASE WHEN function = '生态环境' THEN '生态环境' ELSE {role('unit')} END AS role,
        last_date, record_count, list_filter(names, lambda v: v <> unit) AS variants FROM (
        SELECT prov_code, city, area, function, arg_min(name, rk) AS unit, max(last_date) AS last_date, sum(n)::BIGINT AS record_count,
          list(name ORDER BY best) AS names FROM (
            SELECT prov_code, city, area, function, name, min(rk) AS best, min(rk) AS rk, max(last_date) AS last_date, sum(n) AS n
            FROM {tag}_ranked GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3, 4)""")


relation("proc_rows", "records", "SELECT prov_code, city_code, process_department AS raw, notice_date, county, ord, 0 AS part FROM records")
relation("export_rows", "records", f"""
  SELECT prov_code, city_code, u.x AS raw, notice_date, county, ord, u.i - 1 AS part FROM (
    SELECT *, {split_units('combined_units')} AS parts FROM records), LATERAL (
    SELECT unnest(parts) AS x, unnest(range(1, len(parts) + 1)) AS i) u""")
clean_up("proc", "proc_rows")
clean_up("export", "export_rows")


def sql(query: str) -> str:
    """``query`` with every relation it mentions in front."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in TABLES or name in order:
            return
        for need in RELATIONS[name][0]:
            add(need)
        order.append(name)

    for word in dict.fromkeys(re.findall(r"\w+", query)):
        if word in RELATIONS:
            add(word)
    if not order:
        return query
    heads = ",\n".join(f"{n} AS MATERIALIZED ({RELATIONS[n][1]})" for n in order)  # each once, however often it is mentioned
    body = query.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {heads},\n{body[5:]}"
    return f"WITH {heads}\n{query}"
