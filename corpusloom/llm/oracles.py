"""Queries of this subpackage as SQL, where SQL can state them."""

from __future__ import annotations

_SMOOTHED = "1 + (1000000000 * ({count} + 2)::HUGEINT) // ({total} + 2 * {terms})"
_DIFFERENCE = "(({p}) - ({q})) * (({p}) - ({q})) // (({p}) + ({q}))"


def _smoothed(count: str, total: str, terms: str) -> str:
    return _SMOOTHED.format(count=count, total=total, terms=terms)


ORACLES: dict[str, str] = {
    "op11_source_divergence": rf"""WITH filled AS (
          SELECT row_number() OVER () AS row, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
                 coalesce(source, '') AS source FROM documents),
        words AS (
          SELECT row, lang, source, unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM filled),
        vocabulary AS (
          SELECT lang, term, count(*)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
        counts AS (
          SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN vocabulary USING (lang, term)
          GROUP BY lang, source, term),
        langs AS (
          SELECT lang, count(term)::HUGEINT AS v, coalesce(sum(n), 0)::HUGEINT AS total
          FROM (SELECT DISTINCT lang FROM filled) LEFT JOIN vocabulary USING (lang) GROUP BY lang),
        sides AS (
          SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total
          FROM (SELECT DISTINCT lang, source FROM filled) g LEFT JOIN counts USING (lang, source)
          GROUP BY g.lang, g.source),
        shares AS (
          SELECT s.lang, s.source, o.term, coalesce(c.n, 0) AS n,
                 {_smoothed('coalesce(c.n, 0)', 's.total', 'l.v')} AS p,
                 {_smoothed('o.n', 'l.total', 'l.v')} AS q
          FROM sides s JOIN langs l USING (lang) JOIN vocabulary o USING (lang)
          LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = o.term),
        summed AS (
          SELECT a.lang, a.source, b.source AS item, sum({_DIFFERENCE.format(p='a.p', q='b.p')}) AS value
          FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
          GROUP BY a.lang, a.source, b.source),
        parts AS (
          SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
          FROM sides a JOIN sides b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, {_DIFFERENCE.format(p='p', q='q')} FROM shares WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
              FROM parts)
        WHERE part = 'pair' OR rank <= 10""",
    "op12_formatted_chats": r"""WITH given AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
          UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM given),
        marked AS (
          SELECT *, coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY place) <> role, true) AS begins,
                 length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')) AS chars,
                 length(regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g')) AS role_chars
          FROM placed)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(chars + CASE WHEN begins THEN role_chars + 24 ELSE 3 END)::BIGINT AS formatted_chars,
               count(*) FILTER (begins) AS n_blocks
        FROM marked GROUP BY conv_id""",
    "op10_url_verdicts": r"""WITH cut AS (
          SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        parsed AS (
          SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
        rules(rule_host, rule_path, decision) AS (
          VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
                 ('org', '/fr/', 'allow')),
        fitting AS (
          SELECT page_id, rule_host || rule_path AS rule, decision FROM parsed JOIN rules
            ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
          QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC, length(rule_path) DESC) = 1),
        hosts AS (
          SELECT DISTINCT host AS listed FROM parsed
          WHERE regexp_matches(host, '(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)')),
        blocked AS (
          SELECT page_id, listed FROM parsed JOIN hosts ON host = listed OR ends_with(host, '.' || listed)
          QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(listed) DESC) = 1)
        SELECT p.page_id, p.host, p.path, f.rule,
               coalesce(f.decision, CASE WHEN b.listed IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, b.listed
        FROM parsed p LEFT JOIN fitting f USING (page_id) LEFT JOIN blocked b USING (page_id)""",
}
