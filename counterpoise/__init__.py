"""counterpoise — binary classification on skewed tables, written as Spark jobs.

Layout:

* ``functions``  column expressions (hash sampling, Poisson draws, vector helpers)
* ``sources``    labelled frames from tables, KEEL / CSV text readers, metric sinks
* ``operators``  rebalancing, scaling, noise filtering, instance selection, models, metrics
* ``plans``      preprocessing chains and the preprocessing x model grid

Every operator is a ``DataFrame -> DataFrame`` function (or an estimator whose
``fit`` runs Spark jobs and whose ``transform`` is a lazy column expression).
Randomness always comes from a hash of the row id and a seed, so results do not
depend on how the data is partitioned.
"""

from counterpoise.frame import LABEL, ID, FEATURES, labelled, num_features  # noqa: F401
from counterpoise.session import checkpoint_dir, get_session  # noqa: F401

__version__ = "0.1.0"
