"""DuckDB SQL that the manifest, the mix and the spelling variants must agree with."""

from __future__ import annotations

from chronoloom.llm import mixing, spelling

#: Depth of the trees that the SQL of the manifest is written out for: 3 to this power leaves in a source, and sources.
DEPTHS = {"leaf": 14, "source": 7}


def crc32(value: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, half a byte at a time."""
    table = []
    for i in range(16):
        for _ in range(4):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        table.append(i)
    listed = f"CAST([{', '.join(map(str, table))}] AS BIGINT[])"
    half = lambda c: f"xor({c} >> 4, list_extract({listed}, ({c} & 15) + 1))"
    as_bytes = f"list_transform(regexp_extract_all(hex(encode({value})), '..'), lambda x: CAST(CAST('0x' || x AS INTEGER) AS BIGINT))"
    return f"xor(list_reduce({as_bytes}, lambda c, b: {half(half('xor(c, b)'))}, CAST(4294967295 AS BIGINT)), 4294967295)"


def _tree(name: str, depth: int) -> str:
    """Levels of the tree over ``<name>_n0(grp, i, n, h)`` and the paths of its leaves, ``<name>_p<depth>``."""
    parts = [f"{name}_p0 AS (SELECT grp, i AS leaf, i, n, [] ::STRUCT(b VARCHAR, a VARCHAR)[] AS path FROM {name}_n0)"]
    for k in range(depth):
        parts.append(
            f"""{name}_k{k} AS (SELECT grp, i // 3 AS i, any_value(n) AS n, list(h ORDER BY i) AS kids FROM {name}_n{k} GROUP BY grp, i // 3)"""
        )
        parts.append(
            f"""{name}_n{k + 1} AS (SELECT grp, i, (n + 2) // 3 AS n,
              CASE WHEN n > 1 THEN sha256(array_to_string(kids, '')) ELSE kids[1] END AS h FROM {name}_k{k})"""
        )
        parts.append(
            f"""{name}_p{k + 1} AS (SELECT p.grp, leaf, p.i // 3 AS i, (p.n + 2) // 3 AS n, CASE WHEN p.n = 1 THEN path ELSE list_append(path,
              {{'b': array_to_string(kids[1 : p.i % 3], ''), 'a': array_to_string(kids[p.i % 3 + 2 :], '')}}) END AS path
              FROM {name}_p{k} p JOIN {name}_k{k} q ON p.grp = q.grp AND p.i // 3 = q.i)"""
        )
    return ",\n".join(parts)


def merkle_sql() -> str:
    """Leaves, proofs and roots, level by level."""
    part = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    head = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    cut = "replace(text, chr(10), '')"
    leaves, sources = DEPTHS["leaf"], DEPTHS["source"]
    return f"""WITH leaves AS (SELECT doc_id, coalesce('1' || source, '0') AS grp, sha256({head} || {part('text')}) AS leaf,
          CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0 THEN sha256({head} || {part(cut)})
            ELSE sha256({head} || {part('text')}) END AS again FROM documents),
      numbered AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
          count(*) OVER (PARTITION BY grp) AS n FROM leaves),
      l_n0 AS (SELECT grp, i, n, leaf AS h FROM numbered),
      {_tree('l', leaves)},
      subroots AS (SELECT grp, h FROM l_n{leaves}),
      s_n0 AS (SELECT 0 AS grp, row_number() OVER (ORDER BY grp) - 1 AS i, count(*) OVER () AS n, h FROM subroots),
      {_tree('s', sources)},
      tops AS (SELECT g.grp, g.h AS subroot, p.path, (SELECT h FROM s_n{sources}) AS root
        FROM (SELECT *, row_number() OVER (ORDER BY grp) - 1 AS i FROM subroots) g JOIN s_p{sources} p ON p.leaf = g.i),
      every AS (SELECT doc_id, d.leaf, subroot, root, again, list_concat(p.path, t.path) AS path
        FROM numbered d JOIN l_p{leaves} p ON d.grp = p.grp AND d.i = p.leaf JOIN tops t ON t.grp = d.grp),
      ends AS (SELECT doc_id, leaf, subroot, root,
          sha256(array_to_string(list_transform(path, lambda s: s.b || s.a), '')) AS proof_sha256,
          list_reduce(list_transform(path, lambda s: [s.b, s.a]), lambda h, s: [sha256(s[1] || h[1] || s[2])], [again])[1] AS folded_root FROM every)
      SELECT *, folded_root = root AS verified FROM ends"""


def mix_sql() -> str:
    """Targets, seats by ranking every quotient, and the words of the blocks taken."""
    mix, block, shard = mixing.Mix(), mixing.BLOCK_WORDS, mixing.SHARD_BLOCKS
    weights, most, seed = ", ".join(map(str, mix.weights)), mix.most, mixing.SEED
    words = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
    seats = lambda units, by: f"""(SELECT grp, unit, count(*) AS quota FROM (SELECT u.grp, unit, s.seats,
          row_number() OVER (PARTITION BY u.grp ORDER BY -votes / (2 * nth + 1), unit, nth) AS place
        FROM (SELECT *, unnest(range(most)) AS nth FROM {units} WHERE votes > 0) u JOIN {by} s ON u.grp = s.grp)
        WHERE place <= seats GROUP BY ALL)"""  # noqa: E731
    return f"""WITH RECURSIVE sized AS (SELECT doc_id, coalesce('0' || source, '1') AS grp, {words} AS size,
          md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))) AS draw FROM documents),
      streams AS (SELECT row_number() OVER () AS r, doc_id, grp, size, sum(size) OVER (PARTITION BY grp) AS source_size,
          sum(size) OVER (PARTITION BY grp ORDER BY draw, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS start FROM sized),
      sources AS (SELECT grp, sum(size) AS size, [{weights}][(row_number() OVER (ORDER BY grp) - 1) % {len(mix.weights)} + 1] AS weight
        FROM sized GROUP BY grp),
      whole AS (SELECT {mix.percent} * sum(size) AS total, sum(weight) AS weights FROM sources),
      fill(rest, weights) AS (SELECT total, weights FROM whole UNION
        SELECT * FROM (SELECT w.total - coalesce(sum({100 * most} * size) FILTER (stopped), 0) AS rest,
            w.weights - coalesce(sum(weight) FILTER (stopped), 0) AS weights
          FROM (SELECT s.*, {100 * most} * s.size * f.weights < s.weight * f.rest AS stopped FROM sources s, fill f) x, whole w
          GROUP BY w.total, w.weights) y WHERE weights > 0),
      final AS (SELECT rest, weights FROM fill ORDER BY weights LIMIT 1),
      aims AS (SELECT s.*, CASE WHEN {100 * most} * size * weights < weight * rest THEN CAST(size AS DOUBLE) * {most}
          ELSE CAST(weight * rest AS DOUBLE) / CAST(100 * weights AS DOUBLE) END AS target FROM sources s, final),
      units AS (SELECT '' AS grp, grp AS unit, target AS votes, CAST({most} * ((size + {block - 1}) // {block}) AS BIGINT) AS most FROM aims),
      all_seats AS (SELECT '' AS grp, (total + {50 * block}) // {100 * block} AS seats FROM whole),
      quotas AS (SELECT unit AS grp, quota AS seats FROM {seats('units', 'all_seats')}),
      cut AS (SELECT grp, size, unnest(range(CAST((size + {block * shard - 1}) // {block * shard} AS BIGINT))) AS unit FROM sources WHERE size > 0),
      shards AS (SELECT grp, unit, CAST(least(size - unit * {block * shard}, {block * shard}) AS DOUBLE) AS votes,
          CAST({most} * ((least(size - unit * {block * shard}, {block * shard}) + {block - 1}) // {block}) AS BIGINT) AS most FROM cut),
      shares AS (SELECT s.grp, s.unit, s.most // {most} AS blocks, coalesce(quota, 0) AS quota
        FROM shards s LEFT JOIN {seats('shards', 'quotas')} q ON q.grp = s.grp AND q.unit = s.unit),
      blocks AS (SELECT grp, unit, blocks, quota, unit * {shard} + unnest(range(blocks)) AS block FROM shares),
      times AS (SELECT grp, block, quota // blocks + CASE WHEN row_number() OVER (PARTITION BY grp, unit
          ORDER BY md5('{seed}:' || grp || ':' || block), block) <= quota % blocks THEN 1 ELSE 0 END AS times FROM blocks),
      touched AS (SELECT r, grp, start, size, unnest(range(CAST(start // {block} AS BIGINT), CAST((start + size - 1) // {block} + 1 AS BIGINT))) AS block
        FROM streams WHERE size > 0),
      sums AS (SELECT r, sum(times * (least(start + size, (block + 1) * {block}) - greatest(start, block * {block}))) AS taken
        FROM touched JOIN times USING (grp, block) GROUP BY r)
      SELECT doc_id, CAST(s.size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
      FROM streams s JOIN aims a USING (grp) LEFT JOIN sums USING (r)"""


def spelling_sql() -> str:
    """Near words by what is left when a letter is taken out, and forms followed to their ends."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    h = crc32("doc_id || ':' || run")
    return f"""WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{spelling.RUN}')) AS run
        FROM documents),
      drawn AS (SELECT run, times, h, CAST(h % length(run) AS BIGINT) AS place
        FROM (SELECT run, times, {h} AS h FROM (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL))),
      vocabulary AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (SELECT times, CASE WHEN h % {spelling.DELETED} = 0
          THEN substr(run, 1, place) || substr(run, place + 2) ELSE run END AS word FROM drawn)
        WHERE length(word) >= {spelling.LEAST_LENGTH} GROUP BY word HAVING sum(times) >= {spelling.LEAST_COUNT}),
      holes AS (SELECT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS b
        FROM (SELECT *, unnest(range(length(word))) AS i FROM vocabulary)),
      pairs AS (SELECT x.word, y.word AS near, y.n AS near_n FROM holes x JOIN holes y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
        UNION SELECT h.word, v.word, v.n FROM holes h JOIN vocabulary v ON v.word = h.a || h.b
        UNION SELECT v.word, h.word, h.n FROM holes h JOIN vocabulary v ON v.word = h.a || h.b),
      best AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
          row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM pairs),
      forms AS (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {spelling.TIMES} * n THEN near END AS form,
          CASE WHEN near_n >= {spelling.TIMES} * n THEN near_n END AS form_n
        FROM vocabulary v LEFT JOIN best b ON b.word = v.word AND place = 1),
      walk AS (SELECT word, word AS here, 0 AS step FROM forms
        UNION ALL SELECT w.word, f.form, step + 1 FROM walk w JOIN forms f ON f.word = w.here WHERE f.form IS NOT NULL),
      ends AS (SELECT word, arg_max(here, step) AS root FROM walk GROUP BY word)
      SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""
