"""rookery: a PySpark-native engine for building and scoring chess
reasoning-model training data.

Every operator is a lazy ``DataFrame -> DataFrame`` or ``Column``
function built from Spark SQL built-ins, windows, joins and higher-order
functions. Nothing is collected to the driver.
"""

__version__ = "0.1.0"
