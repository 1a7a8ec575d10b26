"""Training-data operators: one module per operator, their registered queries in ``queries``.

Nothing outside this subpackage imports it. Every operator takes DataFrames and
returns DataFrames, keeps null, empty and repeated rows (each docstring says how),
and reads only the columns it names, so extra columns never clash.
"""
