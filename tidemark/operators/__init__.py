"""DataFrame to DataFrame operators; none of them runs an action unless its docstring says so."""
