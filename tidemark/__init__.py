"""Order, payment and inventory event analytics as Spark DataFrame operators.

Every operator is a function from DataFrames to a DataFrame.  Unless its docstring
says otherwise it accepts batch and streaming input alike.
"""
