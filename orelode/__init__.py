"""orelode: DataFrame transforms for curating catalogues of industrial sites."""
