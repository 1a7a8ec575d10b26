"""cartwheel: catalogue and review analytics expressed as Spark DataFrame/SQL plans.

Every operator is a lazy function ``f(df, *, columns..., params...) -> DataFrame``.
No operator collects data to the driver; the few that must run an action
(MLlib ``fit``, iterative component rounds) say so in their docstring.
"""

__version__ = "0.1.0"
