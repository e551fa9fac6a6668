"""lapwing: timeline analytics on PySpark.

Plain ``DataFrame -> DataFrame`` functions over ordered intervals (cues,
detections, advertisement spans, speech clips).  Nothing here starts a session
or runs an action at import time.
"""

__version__ = "0.1.0"
