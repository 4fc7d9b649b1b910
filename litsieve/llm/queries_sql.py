"""SQL for the operators that SQL can express, over the same tables."""

MIX = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         md5('mix:' || coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')) as place
  from documents),
sizes as (
  select source, cast(sum(size) as bigint) as source_size, 2.0::double * sum(size) as most,
         [5.0, 2.0, 1.0][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)]::double as weight
  from d group by source),
levels as (
  select *, (1.5::double * sum(source_size) over () - coalesce(sum(most) over filled, 0))
            / sum(weight) over rest as level
  from sizes
  window filled as (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding),
         rest as (order by most / weight, source nulls last rows between current row and unbounded following)),
goals as (
  select source, source_size, least(most, weight * coalesce(
           (select max(level) from levels where level * weight < most), 0)) as target
  from levels),
ranked as (
  select *, row_number() over (partition by source order by
    lpad(cast(length(bin(size)) as varchar), 2, '0') || rpad(substr(bin(size), 2, 3), 3, '0'), place, doc_id) as n
  from d)
select r.doc_id, cast(r.size as bigint) as size, g.source_size, g.target,
       cast((floor(rate * n + shift) - floor(rate * (n - 1) + shift)) * r.size as bigint) as taken
from ranked r join (
  select *, case when source_size > 0 then target / source_size else 0 end as rate,
         ('0x' || substr(md5('mix@' || coalesce('=' || source, 'null')), 1, 8))::bigint / 4294967296.0::double as shift
  from goals) g on r.source is not distinct from g.source
"""

EXACT = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = min(doc_id) over same as kept, sha256(norm) as text_sha256
from d window same as (partition by norm)
"""

#: CRC-32 of the bytes of a text: its table, then one step a byte.
_CRC_TABLE = """
crc_table as (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, 3988292384 * (a & 1))) order by i) as tab
  from (select unnest(range(256)) as i))"""


def _crc(text: str) -> str:
    """CRC-32 of a text without a NULL; ``tab`` must be in reach."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint"
    data = f"list_transform(range(strlen({text})), lambda i: {byte})"
    step = "xor(a >> 8, tab[(xor(a, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {data}), lambda a, b: {step}))"


SPELLING = rf"""
with recursive {_CRC_TABLE},
found as (
  select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as run from documents),
runs as (
  select coalesce(cast(doc_id as varchar), '') as doc_id,
         translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n
  from found where length(run) > 5 group by all),
hashed as (select run, n, {_crc("doc_id || ':' || run")} as h from runs, crc_table),
spoiled as (
  select n, case when h % 199 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
  from hashed),
words as (select word, cast(sum(n) as bigint) as n from spoiled where length(word) > 5 group by word having sum(n) > 4),
cuts as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select a.word, b.word as near, b.n as near_n from cuts a join cuts b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, b.word, b.n from cuts a join words b on a.rest = b.word
  union select b.word, a.word, a.n from cuts a join words b on a.rest = b.word),
best as (
  select word, count(*) as n_near, max(near_n) as form_n, arg_min(near, (-near_n, near)) as form
  from near group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when b.form_n >= 5 * w.n then b.form end as form,
         case when b.form_n >= 5 * w.n then b.form_n end as form_n
  from words w left join best b on w.word = b.word),
chain as (
  select word, word as root from forms
  union all select c.word, f.form from chain c join forms f on c.root = f.word where f.form is not null),
ends as (select c.word, c.root from chain c join forms f on c.root = f.word where f.form is null)
select f.word, f.form, e.root, f.n, f.n_near, f.form_n from forms f join ends e on f.word = e.word
"""


def _leaf(n_chars: str) -> str:
    texts = ("cast(doc_id as varchar)", "source", "lang", f"cast({n_chars} as varchar)", "text")
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


def _pairs(name: str, leaves: str) -> str:
    """All nodes (tree, level, pos, n, digest) above the rows (tree, pos, n, leaf)."""
    return f"""{name} as (
  select tree, 0 as level, pos, n, leaf as digest from {leaves}
  union all
  select tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' order by pos))
  from {name} where n > 1 group by tree, level, pos // 2, n)"""


def _folding(name: str, start: str, nodes: str) -> str:
    """Each leaf of ``start`` folded up with the siblings found among the nodes."""
    return f"""{name} as (
  select {start}
  union all
  select f.row, f.tree, f.level + 1, f.pos // 2, (f.n + 1) // 2,
         sha256(case when f.pos % 2 = 1 then s.digest || f.digest else f.digest || coalesce(s.digest, '') end)
  from {name} f left join {nodes} s on s.tree = f.tree and s.level = f.level and s.pos = xor(f.pos, 1)
  where f.n > 1)"""


MANIFEST = f"""
with recursive {_CRC_TABLE},
rows as (
  select doc_id, coalesce('=' || lang, '') as tree, {_leaf("n_chars")} as leaf,
         case when {_crc("cast(doc_id as varchar)")} % 7 = 0 then {_leaf("(n_chars + 1)")} end as changed
  from documents, crc_table),
leaves as (
  select *, row_number() over () as row, row_number() over line - 1 as pos, count(*) over (partition by tree) as n
  from rows window line as (partition by tree order by doc_id nulls first, leaf)),
{_pairs("nodes", "leaves")},
tops as (
  select '' as tree, tree as branch, digest as leaf, row_number() over (order by tree) - 1 as pos, count(*) over () as n
  from nodes where n = 1),
{_pairs("upper_nodes", "tops")},
siblings as (
  select l.row, 0 as part, s.level, s.digest from leaves l join nodes s
    on s.tree = l.tree and s.n > 1 and s.pos = xor(l.pos >> s.level, 1)
  union all
  select l.row, 1, s.level, s.digest from leaves l join tops t on t.branch = l.tree
    join upper_nodes s on s.n > 1 and s.pos = xor(t.pos >> s.level, 1)),
proofs as (select row, string_agg(digest, '' order by part, level) as path from siblings group by row),
{_folding("folded", "row, tree, 0 as level, pos, n, coalesce(changed, leaf) as digest from leaves", "nodes")},
{_folding("upper_folded",
          "f.row, '' as tree, 0 as level, t.pos, t.n, f.digest from folded f join tops t on t.branch = f.tree where f.n = 1",
          "upper_nodes")}
select l.doc_id, l.leaf, t.leaf as subroot, r.digest as root, sha256(coalesce(p.path, '')) as proof_sha256,
       f.digest as folded_root, f.digest = r.digest as verified
from leaves l join tops t on t.branch = l.tree join upper_nodes r on r.n = 1
  join upper_folded f on f.row = l.row and f.n = 1 left join proofs p on p.row = l.row
"""
