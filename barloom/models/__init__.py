from .per_symbol import (  # noqa: F401
    Fitted,
    factorization,
    fit_per_symbol,
    forest,
    load_models,
    save_models,
    score_per_symbol,
    write_scores,
)
from .kernels import FactorPairs, GatedCells, RecurrentCells  # noqa: F401
from .shards import ShardFit, fit_factorization, fit_gated_net, fit_recurrent_net, score_net  # noqa: F401
from .trees import fit_forests, load_forests, save_forests, score_forests  # noqa: F401
