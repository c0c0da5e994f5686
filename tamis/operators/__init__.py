"""DataFrame -> DataFrame operators. None of them runs an action unless its name says ``assert_``."""
