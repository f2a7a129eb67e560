"""brickyard: property-investment analytics expressed as Spark DataFrame jobs.

Every public function takes and returns DataFrames (plus plain parameters
such as ``as_of``); nothing inside a transform triggers an action except
the few explicit size checks documented where they occur.
"""

__all__ = ["session"]
