"""DataFrame -> DataFrame operators. All are lazy except model fitting."""
