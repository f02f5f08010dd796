"""SQL for DuckDB that the queries of some operators must equal."""

from __future__ import annotations

from dimloom.llm import centroids, shards

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

JACCARD_JOIN = f"""
with recursive
words as (
    select doc_id, list_transform(
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'),
        lambda w: translate(w, '{CAPITALS}', '{CAPITALS.lower()}')) as w
    from documents),
sets as (
    select doc_id, case
        when len(w) >= 5 then list_distinct(list_transform(
            range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')))
        when len(w) > 0 then [array_to_string(w, ' ')]
        else [] end as shingles
    from words),
held as (select doc_id, len(shingles) as n, unnest(shingles) as shingle from sets),
pairs as (
    select a.doc_id as a, b.doc_id as b
    from held a join held b on a.shingle = b.shingle and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n
    having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached(a, b) as (
    select doc_id, doc_id from documents
    union
    select r.a, p.b from reached r join pairs p on r.b = p.a)
select s.doc_id, cast(len(s.shingles) as bigint) as n_shingles,
    (select min(b) from reached r where r.a = s.doc_id) as component_id,
    (select count(*) from pairs p where p.a = s.doc_id) as n_links
from sets s"""


def crc32(blob: str) -> str:
    """The check sum by its definition, four bits at a time."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    numbers = "[" + ", ".join(f"{v}::bigint" for v in table) + "]"

    def four_bits(x: str) -> str:
        return f"xor(({x}) >> 4, {numbers}[(({x}) & 15) + 1])"

    whole = (
        f"list_transform(regexp_extract_all(hex({blob}), '..'), "
        "lambda digits: ('0x' || digits)::bigint)"
    )
    step = four_bits(four_bits("xor(c, b)"))
    reduced = f"list_reduce({whole}, lambda c, b: {step}, 4294967295::bigint)"
    return f"xor({reduced}, 4294967295::bigint)"


def sharding(count: int, seed: int) -> str:
    """A row's number goes through the rounds again and again, until it is below the row count
    after the last of them."""
    keys = ", ".join(
        f"({k}, {a}::bigint, {t}::bigint, {p}::bigint)"
        for k, (a, t, p) in enumerate(shards.round_keys(seed))
    )
    prime = shards.PRIME
    start = f"((walk.r + keys.add) % {prime})"
    mixed = f"(({start} * {start}) % {prime} * keys.times + keys.plus) % {prime}"
    return f"""
with recursive
measured as (
    select doc_id, cast(octet_length(encode(coalesce(text, ''))) as bigint) + 1 as size,
        {crc32("encode(coalesce(text, ''))")} as text_crc32
    from documents),
numbered as (
    select *, row_number() over (order by doc_id nulls first, size, text_crc32) - 1 as id
    from measured),
total as (
    select count(*) as n, cast(floor(sqrt(greatest(count(*) - 1, 0))) as bigint) + 1 as side
    from documents),
keys(k, add, times, plus) as (values {keys}),
walk(id, l, r, k) as (
    select id, id // side, id % side, 0 from numbered, total
    union all
    select walk.id, walk.r, (walk.l + {mixed}) % side, walk.k + 1
    from walk join keys on keys.k = walk.k % {shards.ROUNDS}, total
    where walk.k = 0 or walk.k % {shards.ROUNDS} <> 0 or walk.l * side + walk.r >= n),
ended as (
    select id, l * side + r as place from walk, total
    where k > 0 and k % {shards.ROUNDS} = 0 and l * side + r < n)
select doc_id, size, text_crc32, 'rows' as law, cast(place % {count} as integer) as shard,
    cast(place // {count} as bigint) as slot, cast(null as integer) as grown_shard
from numbered join ended using (id)"""


def clustering(clusters: int, rounds: int, seed: int) -> str:
    """Each round is a distance to every centroid, the nearest one, and the floors of the means."""

    def nearest(nth: int) -> str:
        return f"""
far{nth} as materialized (
    select id, k, sum((v - c) * (v - c)) as far
    from cells join c{nth} using (dim) group by id, k),
near{nth} as materialized (
    select id, k, far from far{nth}
    qualify row_number() over (partition by id order by far, k) = 1)"""

    steps = "".join(
        f"""{nearest(nth)},
sums{nth} as (
    select k, dim, sum(v) as total, count(*) as n
    from near{nth} join cells using (id) group by k, dim),
c{nth + 1} as materialized (
    select k, dim, coalesce((total - ((total % n) + n) % n) // n, c) as c
    from c{nth} left join sums{nth} using (k, dim)),"""
        for nth in range(rounds)
    )
    return f"""
with
kept as (
    select row_number() over (order by vec_id) as id, vec_id,
        list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as whole
    from embeddings
    where len(embedding) = 64
        and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
cells as materialized (
    select id, vec_id, unnest(whole) as v, generate_subscripts(whole, 1) as dim from kept),
chosen as (
    select row_number() over (order by sha256('{seed}:' || vec_id)) - 1 as k, whole
    from kept qualify k < {clusters}),
c0 as materialized (
    select k, unnest(whole) as c, generate_subscripts(whole, 1) as dim from chosen),{steps}{nearest(rounds)},
digests as (
    select k, sha256(string_agg(c::varchar, ',' order by dim)) as digest from c{rounds} group by k)
select vec_id, cast(k as integer) as cluster, cast(far as bigint) as distance,
    cast(sum(far) over (partition by k) as bigint) as cluster_inertia,
    cast(sum(far) over () as bigint) as inertia, digest as centroid_sha256
from near{rounds} join kept using (id) join digests using (k)"""


SPELLING_FORMS = f"""
with recursive
runs as (
    select doc_id, run, count(*) as times from (
        select doc_id, unnest(regexp_extract_all(
            translate(text, '{CAPITALS}', '{CAPITALS.lower()}'), '[a-zÀ-ÿ]+')) as run
        from documents where text is not null)
    where length(run) >= 5 group by doc_id, run),
hashed as (
    select run, times, {crc32("encode(doc_id || ':' || run)")} as h from runs),
cut as (
    select times, case when h % 97 = 0
        then run[: h % length(run)] || run[h % length(run) + 2 :] else run end as word
    from hashed),
words as materialized (
    select word, cast(sum(times) as bigint) as n from cut
    where length(word) >= 5 group by word having sum(times) >= 3),
less as materialized (
    select word, n, i, word[: i - 1] || word[i + 1 :] as rest
    from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
pairs as materialized (
    select a.word as word, b.word as other, b.n as n
    from less a join less b on a.rest = b.rest and a.i = b.i and a.word <> b.word
    union
    select a.word, b.word, b.n from less a join words b on a.rest = b.word
    union
    select b.word, a.word, a.n from less a join words b on a.rest = b.word),
best as (
    select word, count(*) as n_near, arg_min(other, (-n, other)) as other, max(n) as other_n
    from pairs group by word),
forms as materialized (
    select word, w.n, coalesce(n_near, 0) as n_near,
        case when other_n >= 2 * w.n then other end as form,
        case when other_n >= 2 * w.n then other_n end as form_n
    from words w left join best using (word)),
walk(word, root) as (
    select word, coalesce(form, word) from forms
    union
    select walk.word, forms.form from walk join forms on walk.root = forms.word
    where forms.form is not null)
select word, form, root, n, n_near, form_n
from forms join walk using (word) join (
    select word as root from forms where form is null) using (root)"""


ORACLES = {
    "op12_spelling_forms": SPELLING_FORMS,
    "op13_centroid_clusters": clustering(centroids.CLUSTERS, centroids.ROUNDS, 3),
    "op7_jaccard_join": JACCARD_JOIN,
    "op8_sharding": sharding(8, shards.SEED),
}
