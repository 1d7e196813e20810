"""earworm: implicit-feedback recommendation as lazy Spark DataFrame plans.

Subpackages
-----------
sources     readers / writers for interaction logs, tracks, ratings, factors
functions   column-expression helpers (hash splits, rounding, DCG)
operators   DataFrame -> DataFrame operators (identity, ratings, splits,
            popularity, ranking metrics, ALS, inner-product retrieval)
plans       the registered end-to-end queries and their SQL oracles
streaming   the listen-count operator run incrementally on a stream
"""

from earworm.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
