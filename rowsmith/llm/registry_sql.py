"""DuckDB SQL of the queries whose SQL is longer than a few lines."""

NEAR = """
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as l
  from documents),
s as (
  select distinct doc_id, unnest(case when len(l) >= 2 then list_transform(range(1, len(l)), lambda i: l[i] || ' ' || l[i + 1]) else l end) as g from w),
k as (select g, row_number() over () as i from (select distinct g from s)),
e as (select doc_id, i from s join k using (g)),
n as (select doc_id, count(*) as n from e group by doc_id),
p as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from e a join e b on a.i = b.i and a.doc_id < b.doc_id
  group by 1, 2),
l as (
  select p.a, p.b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b
  where 100 * c >= 80 * (x.n + y.n - c)),
u as (select a, b from l union all select b, a from l),
r as (
  select doc_id as a, doc_id as b from w
  union
  select r.a, u.b from r join u on u.a = r.b),
m as (select a as doc_id, min(b) as component_id from r group by a)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, m.component_id, w.doc_id = m.component_id as kept
from w left join n using (doc_id) join m using (doc_id)
"""


def _spans(kind: int, pattern: str, good: str = "true") -> str:
    """SQL of the spans of a pattern's matches: matches and the pieces between them alternate."""
    p = pattern.replace("'", "''")
    return f"""select doc_id, {kind} as k, b - len(m) as a, b, {good} as good from (
    select doc_id, h[i] as m, sum(len(g[i]) + len(h[i])) over (partition by doc_id order by i) as b from (
      select doc_id, h, g, unnest(range(1, len(h) + 1)) as i from (select doc_id, regexp_extract_all(t, '{p}') as h, regexp_split_to_array(t, '{p}') as g from d)))"""


_VALUE = "len(regexp_extract(m, '{p}', 2)) >= {n}"


def secrets_sql() -> str:
    """The whole scan: base spans, weak candidates and their linking by distance."""
    from rowsmith.llm import secrets as S

    value = _VALUE.replace("{p}", S.ASSIGN.replace("'", "''")).replace("{n}", str(S.MIN_ASSIGNED))
    parts = [_spans(0, S.ASSIGN, value), _spans(1, S.ACCESS), _spans(2, S.HEX), _spans(3, S.IDENT), _spans(4, S.OPAQUE, "regexp_matches(m, '[0-9]') and regexp_matches(m, '[A-Za-z]')"), _spans(5, S.ENDPOINT)]
    roles = {"base": "k <= 2", "id": "k in (1, 3)", "secret": "k in (0, 2, 4)", "ends": "k = 5"}
    seen = ", ".join(f"max(case when {c} then b end) over p as {r}_before, min(case when {c} then a end) over n as {r}_after" for r, c in roles.items())
    near = lambda r: f"(coalesce(a - {r}_before <= {S.REACH}, false) or coalesce({r}_after - b <= {S.REACH}, false))"
    names = "[" + ", ".join(f"'{k}'" for k in S.KINDS) + "]"
    line = f"string_agg({names}[k + 1] || ':' || a::bigint || ':' || b::bigint, ',' order by a, k, b)"
    return f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
s as (select doc_id, k, a, b from ({" union all ".join(parts)}) where good),
w as (select *, {seen} from s
  window p as (partition by doc_id order by a, k, b rows between unbounded preceding and 1 preceding),
         n as (partition by doc_id order by a, k, b rows between 1 following and unbounded following)),
r as (select doc_id, k, a, b from w where k <= 2 or (
  case k when 3 then {near("secret")} when 4 then {near("id")} or {near("ends")} else {near("id")} and {near("secret")} end
  and not coalesce(base_before > a, false) and not coalesce(base_after < b, false))),
g as (select doc_id, count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access, count(*) filter (where k = 2) as n_hex,
  {line} filter (where k <= 2) as base, {line} as spans from r group by 1)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join g using (doc_id)
"""
