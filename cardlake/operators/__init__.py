"""DataFrame -> DataFrame operators: de-duplication, reshaping, quality, silver and gold builders."""
