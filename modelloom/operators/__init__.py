from modelloom.operators.asof import asof_join
from modelloom.operators.bloom import semi_join
from modelloom.operators.checks import not_null, passed, suite, unique
from modelloom.operators.diff import multiset_intersect, table_difference
from modelloom.operators.distinct import distinct_aggregates
from modelloom.operators.enrich import (
    embed_text,
    enrich,
    lead_sentence,
    lookup,
    ticket_prompt,
    words,
)
from modelloom.operators.fanout import fan_out, monte_carlo_pi
from modelloom.operators.intervals import interval_join
from modelloom.operators.joins import merge
from modelloom.operators.lattice import lattice, merge_lattice
from modelloom.operators.materialize import (
    append_table,
    create_schema,
    create_view,
    drop,
    kind_of,
    replace_table,
    snapshot,
    time_limit,
)
from modelloom.operators.parallel import parallel_map, worker_resources
from modelloom.operators.ranks import add_ranks, exact_quantiles, top_k
from modelloom.operators.scoring import (
    churn_score,
    fit_centroids,
    logistic,
    nearest_centroid,
    order_activity,
    score_batches,
)

__all__ = [
    "add_ranks", "append_table", "asof_join", "churn_score", "create_schema", "create_view",
    "distinct_aggregates", "drop", "embed_text", "enrich", "exact_quantiles", "fan_out",
    "fit_centroids", "interval_join", "kind_of", "lattice", "lead_sentence", "logistic", "lookup",
    "merge", "merge_lattice", "monte_carlo_pi", "multiset_intersect", "nearest_centroid",
    "not_null", "order_activity", "parallel_map", "passed", "replace_table", "score_batches",
    "semi_join", "snapshot", "suite", "table_difference", "ticket_prompt", "time_limit", "top_k",
    "unique", "words", "worker_resources",
]
