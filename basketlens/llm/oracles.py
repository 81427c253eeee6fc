"""The operators' results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from basketlens.llm.licenses import BLOCK, CONTAINMENT, TEMPLATES
from basketlens.llm.mixing import GRID, SLACK, SLOTS

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP7 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents
), g AS (
  SELECT bare, count(*) AS group_size,
         arg_min(doc_id, (-n, doc_id)) AS keep_id
  FROM d GROUP BY bare
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256
FROM d JOIN g USING (bare)
"""


def op1(entropy_share: float = 0.95, max_repeats: float = 4.0, seed: int = 42) -> str:
    """Both bisections run as recursive queries over the sources' shares."""
    entropy = (
        "(SELECT ln(sum(exp(x * ln_p))) - x * sum(exp(x * ln_p) * ln_p) / sum(exp(x * ln_p)) FROM "
        f"(SELECT ln_p, {{point}} / {GRID}::DOUBLE AS x FROM shares) GROUP BY x)"
    )
    often = (
        "(SELECT max(exp((x - 1) * ln_p)) / sum(exp(x * ln_p)) FROM "
        f"(SELECT ln_p, {{point}} / {GRID}::DOUBLE AS x FROM shares) GROUP BY x)"
    )
    enough = f"{entropy.format(point='((low + high + 1) // 2)')} >= {entropy_share} * ln(k) - 1e-12"
    much = f"{often.format(point='((low + high + 1) // 2)')} > {max_repeats} * (1 + 1e-12)"
    return f"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(source, '') AS source, {WORDS} AS n_tokens FROM documents
), rows_ AS (SELECT * FROM t WHERE n_tokens > 0),
sources AS (SELECT source, sum(n_tokens)::BIGINT AS tokens, count(*) AS n_docs FROM rows_ GROUP BY source),
shares AS (
  SELECT *, ln(tokens / (SELECT sum(tokens) FROM sources)) AS ln_p, (SELECT count(*) FROM sources) AS k FROM sources
), by_entropy AS (
  SELECT 0 AS low, {GRID} AS high, k FROM shares GROUP BY k
  UNION ALL
  SELECT CASE WHEN ok THEN middle ELSE low END, CASE WHEN ok THEN high ELSE middle - 1 END, k
  FROM (SELECT low, high, k, (low + high + 1) // 2 AS middle, {enough} AS ok FROM by_entropy WHERE low < high)
), first_point AS (SELECT low AS point FROM by_entropy WHERE low = high),
by_repeats AS (
  SELECT point AS low, {GRID} AS high FROM first_point
  UNION ALL
  SELECT CASE WHEN ok THEN middle ELSE low END, CASE WHEN ok THEN high ELSE middle - 1 END
  FROM (SELECT low, high, (low + high + 1) // 2 AS middle, {much} AS ok FROM by_repeats WHERE low < high)
), chosen AS (
  SELECT CASE WHEN {often.format(point="point")} > {max_repeats} * (1 + 1e-12)
    THEN least({GRID}, (SELECT low + 1 FROM by_repeats WHERE low = high)) ELSE point END / {GRID}::DOUBLE AS x
  FROM first_point
), weighted AS (
  SELECT *, round(share, 9) AS weight FROM (
    SELECT source, tokens, n_docs, exp(ln_p * x - (SELECT ln(sum(exp(ln_p * x))) FROM shares, chosen)) AS share
    FROM shares, chosen)
), quotas AS (
  SELECT source, weight, tokens, ceil(sqrt(n_docs))::BIGINT AS n_blocks,
         least(floor((SELECT sum(tokens) FROM sources) * share * (1 + {SLACK!r}))::BIGINT, floor(tokens * {max_repeats})::BIGINT) AS quota
  FROM weighted
), drawn AS (
  SELECT rows_.*, quotas.* EXCLUDE (source), epoch,
         ('0x' || substr(md5(concat_ws('|', '{seed}', epoch::VARCHAR, doc_id::VARCHAR)), 1, 8))::BIGINT AS key
  FROM rows_ JOIN quotas USING (source), unnest(range(0, ceil(quota / tokens)::BIGINT)) AS e(epoch)
  WHERE quota > 0
), placed AS (
  SELECT *, epoch * tokens + sum(n_tokens) OVER (
      PARTITION BY source, epoch ORDER BY key % n_blocks, key, doc_id
      ROWS UNBOUNDED PRECEDING)::BIGINT - n_tokens AS start FROM drawn
)
SELECT doc_id, source, epoch, floor(start * {SLOTS} / quota)::BIGINT AS slot, n_tokens, weight
FROM placed WHERE start < quota
"""


def op3(min_sites: int = 10) -> str:
    return rf"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, source, line_no, lines[line_no] AS line, trim(lines[line_no], e' \t\n\x0b\f\r') AS bare
  FROM d, unnest(range(1, len(lines) + 1)) AS r(line_no)
), spread AS (
  SELECT bare, min((doc_id, line_no)) AS first FROM l WHERE bare <> ''
  GROUP BY bare HAVING count(DISTINCT source) >= {min_sites}
), marked AS (
  SELECT l.*, spread.bare IS NOT NULL AND (doc_id, line_no) <> spread.first AS gone
  FROM l LEFT JOIN spread USING (bare)
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
FROM marked GROUP BY doc_id
"""


def op6(part_chars: int = 32_768, turn_chars: int = 32) -> str:
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), placed AS (
  SELECT *, row_number() OVER w AS nth, (sum(length(text) + {turn_chars}) OVER w - length(text) - {turn_chars}) // {part_chars} AS part
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
), parties AS (SELECT DISTINCT conv_id, role AS assistant FROM t WHERE role <> 'system'),
views AS (
  SELECT conv_id, assistant, part::BIGINT AS part, nth, role = assistant AS loss, text || '<|end|>' || chr(10) AS body,
         CASE WHEN role = 'system' THEN '<|system|>' WHEN role = assistant THEN '<|assistant|>'
              ELSE '<|user name=' || role || '|>' END || chr(10) AS header
  FROM placed JOIN parties USING (conv_id)
), spans AS (
  SELECT *, (sum(length(header) + length(body)) OVER (PARTITION BY conv_id, assistant, part ORDER BY nth ROWS UNBOUNDED PRECEDING))::BIGINT AS stop
  FROM views
)
SELECT conv_id, assistant, part, count(*) AS n_turns, string_agg(header || body, '' ORDER BY nth) AS text,
       coalesce(string_agg((stop - length(body)) || ':' || stop, ' ' ORDER BY nth) FILTER (loss), '') AS loss_spans,
       coalesce(sum(length(body)) FILTER (loss), 0)::BIGINT AS loss_chars
FROM spans GROUP BY conv_id, assistant, part
"""


def op8() -> str:
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
    words = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    return f"""
WITH t AS (SELECT license, {words} AS ws FROM (VALUES {rows}) AS v(license, text)),
known AS (SELECT DISTINCT license, len(ws) - 1 AS m, ws[i] || ' ' || ws[i + 1] AS pair FROM t, unnest(range(1, len(ws))) AS r(i)),
sizes AS (SELECT license, count(*) AS n FROM known GROUP BY license),
d AS (SELECT doc_id, {words} AS ws FROM documents),
s AS (SELECT doc_id, i - 1 AS i, ws[i] || ' ' || ws[i + 1] AS pair FROM d, unnest(range(1, len(ws))) AS r(i)),
hit AS (SELECT doc_id, license, m, i, pair FROM s JOIN known USING (pair)),
blocks AS (SELECT DISTINCT doc_id, license, i // {BLOCK} AS b FROM hit),
shares AS (
  SELECT doc_id, license, b, count(DISTINCT pair) AS c FROM blocks JOIN hit USING (doc_id, license)
  WHERE i BETWEEN b * {BLOCK} - m AND b * {BLOCK} + {BLOCK} + m - 1 GROUP BY doc_id, license, b
)
SELECT doc_id, license, max(c / n) AS containment FROM shares JOIN sizes USING (license)
GROUP BY doc_id, license HAVING max(c / n) >= {CONTAINMENT}
"""


def op11(length: int = 100, block: int = 2000) -> str:
    """Bytes are pairs of hex digits; blocks keep the cutting of a long text linear."""
    return f"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, (octet_length(encode(coalesce(text, ''))))::BIGINT AS n_bytes FROM documents
), cut AS (
  SELECT doc_id, b * {block} AS base, least({block}, n_bytes - {length - 1} - b * {block}) AS n, h[b * {2 * block} + 1:(b + 1) * {2 * block} + {2 * length}] AS piece
  FROM (SELECT *, unnest(range(0, (n_bytes - {length} + {block}) // {block})) AS b FROM d WHERE n_bytes >= {length})
), strings AS (
  SELECT doc_id, base + i AS pos, piece[2 * i + 1:2 * i + {2 * length}] AS s FROM (SELECT *, unnest(range(0, n)) AS i FROM cut)
), later AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY s ORDER BY doc_id, pos) AS nth FROM strings) WHERE nth > 1
), marked AS (
  SELECT doc_id, pos, CASE WHEN pos > lag(pos) OVER w + {length} OR lag(pos) OVER w IS NULL THEN 1 ELSE 0 END AS new
  FROM later WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), spans AS (
  SELECT doc_id, min(pos) AS start, max(pos) + {length} AS stop
  FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM marked) GROUP BY doc_id, span
), gaps AS (
  SELECT doc_id, coalesce(lag(stop) OVER w, 0) AS a, start AS b, stop - start AS size, 1 AS span FROM spans
  WINDOW w AS (PARTITION BY doc_id ORDER BY start)
  UNION ALL
  SELECT d.doc_id, coalesce(max(stop), 0), any_value(n_bytes), 0, 0 FROM d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id
)
SELECT doc_id, any_value(n_bytes) AS n_bytes, sum(size)::BIGINT AS n_removed, sum(span)::BIGINT AS n_spans,
       sha256(unhex(string_agg(h[2 * a + 1:2 * b], '' ORDER BY a, b))) AS kept_sha256
FROM d JOIN gaps USING (doc_id) GROUP BY doc_id
"""


OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM cut
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

LEAF = "sha256(concat({}))".format(
    ", ".join(
        f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
        for c in ("doc_id", "source", "lang", "n_chars", "{text}")
    )
)


def crc32(text: str) -> str:
    """The unsigned crc32 of a string of ASCII characters, bit by bit."""
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda c, i: {step})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT for x in string_split({text}, '')]), lambda c, b: {byte}), 4294967295)"


def op13() -> str:
    """Trees are levels of one recursive query; a second one walks from every leaf to the root."""
    level = """
  SELECT tier, tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY tier, tree, level, idx // 8, n"""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {LEAF.format(text="text")} AS leaf,
         CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0 THEN {LEAF.format(text=lowered)} ELSE {LEAF.format(text="text")} END AS shown
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), low(tier, tree, level, idx, n, digest) AS (
  SELECT 0, tree, 0, rank, n, leaf FROM ranked UNION ALL {level.format(name="low")}
), subroots AS (
  SELECT tree, level AS depth, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM low WHERE n = 1
), high(tier, tree, level, idx, n, digest) AS (
  SELECT 1, '', 0, place, (SELECT count(*) FROM subroots), subroot FROM subroots UNION ALL {level.format(name="high")}
), nodes AS (SELECT * FROM low UNION ALL SELECT * FROM high),
sides AS (
  SELECT a.tier, a.tree, a.level, a.idx,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM nodes a JOIN nodes b ON a.tier = b.tier AND a.tree = b.tree AND a.level = b.level AND a.idx // 8 = b.idx // 8
  WHERE a.n > 1 GROUP BY a.tier, a.tree, a.level, a.idx
), walk(doc_id, leaf, subroot, place, tier, tree, level, idx, depth, siblings, folded) AS (
  SELECT doc_id, leaf, subroot, place, 0, tree, 0, rank, depth, '', shown FROM ranked JOIN subroots USING (tree)
  UNION ALL
  SELECT doc_id, leaf, subroot, place, tier, tree, level, idx, depth, siblings, folded FROM (
    SELECT w.doc_id, w.leaf, w.subroot, w.place, w.tier, w.tree, w.level + 1 AS level, w.idx // 8 AS idx, w.depth,
           w.siblings || s.l || s.r AS siblings, sha256(s.l || w.folded || s.r) AS folded
    FROM walk w JOIN sides s ON w.tier = s.tier AND w.tree = s.tree AND w.level = s.level AND w.idx = s.idx
    UNION ALL
    SELECT doc_id, leaf, subroot, place, 1, '', 0, place, (SELECT max(level) FROM high), siblings, folded
    FROM walk WHERE tier = 0 AND level = depth
  )
)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM walk JOIN (SELECT digest AS root FROM high WHERE n = 1) ON true
WHERE tier = 1 AND level = depth
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_mix_sources": op1(),
        "op3_line_dedup": op3(),
        "op6_chat_format": op6(),
        "op7_exact_dedup": OP7,
        "op8_license_scan": op8(),
        "op11_suffix_dedup": op11(),
        "op12_fill_in_middle": OP12,
        "op13_merkle_manifest": op13(),
    }
