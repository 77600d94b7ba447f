"""terrafold: geolocated sample analytics expressed as Spark DataFrame plans.

``functions``  column expressions (measurement parsing, geometry, sizing rules)
``operators``  DataFrame -> DataFrame operators
``sources``    readers and writers
``plans``      whole runs composed from the operators
"""

__version__ = "0.1.0"
