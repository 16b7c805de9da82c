"""Jobs from DataFrame to DataFrame: extraction, graph, quality, change capture, search."""
