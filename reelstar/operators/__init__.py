from reelstar.operators.latest import dedup, first_n_per_key, latest_per_key  # noqa: F401
