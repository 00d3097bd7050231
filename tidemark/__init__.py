"""Event and change-data analytics as plain PySpark transforms.

Every operator is a ``DataFrame -> DataFrame`` function. The same function
serves a batch table and a stream, so a rebuilt table and a live one come from
one definition.
"""

__version__ = "0.1.0"
