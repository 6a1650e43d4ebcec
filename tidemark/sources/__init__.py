"""Sources and sinks: landing folders, pipeline tables, schema drift, sample inputs."""
