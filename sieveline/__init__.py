"""sieveline: supervised learning on wide tables as composable Spark DataFrame operators."""
