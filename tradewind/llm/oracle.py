"""DuckDB SQL for the operators that SQL can express."""


def _clusters(rounds: int, k: int) -> str:
    """The SQL of centroid clustering: every vector is compared with every centroid, round by round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        near{i} as (
            select vec_id, any_value(x.v) as v, min({{'away': away, 'cluster': cluster}}) as best from (
                select vec_id, x.v, cluster, list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as away
                from vectors x cross join centroids{i} c
            ) x group by vec_id
        )""")
        if i < rounds:
            steps.append(f"""
        sums{i} as (
            select best.cluster as cluster, i, sum(v[i]) as s, count(*) as n
            from near{i} cross join range(1, 65) places(i) group by all
        ), moved{i} as (
            select cluster, list(cast((s - (s % n + n) % n) // n as bigint) order by i) as v from sums{i} group by cluster
        ), centroids{i + 1} as (
            select cluster, coalesce(moved{i}.v, centroids{i}.v) as v from centroids{i} left join moved{i} using (cluster)
        )""")
    return f"""
        with vectors as (
            select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
            from embeddings
            where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), centroids0 as (
            select row_number() over (order by sha256('2:' || vec_id)) - 1 as cluster, v from vectors
            order by sha256('2:' || vec_id) limit {k}
        ),{",".join(steps)}
        select vec_id, cast(best.cluster as integer) as cluster, cast(best.away as bigint) as distance,
               cast(sum(best.away) over (partition by best.cluster) as bigint) as cluster_inertia,
               cast(sum(best.away) over () as bigint) as inertia,
               sha256(array_to_string(c.v, ',')) as centroid_sha256
        from near{rounds} join centroids{rounds} c on c.cluster = best.cluster
    """


ORACLE = {
    "op10_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
        from documents
        window same as (partition by coalesce(text, ''))
    """,
    "op6_embedding_dedup": """
        with recursive vectors as (
            select vec_id, label, cast(embedding as double[]) as e from embeddings
        ), links as (
            select x.vec_id as a, y.vec_id as b from vectors x join vectors y on x.label = y.label
            where x.vec_id <> y.vec_id and list_cosine_similarity(x.e, y.e) >= 0.98
        ), reached(vec_id, other) as (
            select vec_id, vec_id from vectors
            union
            select vec_id, b from reached join links on other = a
        ), components as (
            select vec_id, min(other) as component_id from reached group by vec_id
        ), counts as (
            select a as vec_id, count(*) as n from links group by a
        )
        select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
        from components left join counts using (vec_id)
    """,
    "op13_centroids": _clusters(rounds=5, k=40),
}
