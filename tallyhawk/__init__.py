"""tallyhawk: a Spark-native history warehouse and card-fraud reporting library.

The library keeps type-2 slowly changing dimensions up to date from change
sets or full snapshots, loads append-only facts without duplicates, joins
facts to the dimension version valid at the moment of each operation, and
evaluates four fraud rules into an idempotent daily report.  Every operator
takes and returns DataFrames, so Catalyst plans the whole chain.
"""

from tallyhawk.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
__version__ = "0.1.0"
