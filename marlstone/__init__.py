"""marlstone: metadata-driven lakehouse pipelines and star-schema reporting on PySpark."""
