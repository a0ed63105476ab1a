"""Licence texts and headers as they are published, with the licences that they tell."""

BSD_CONDITIONS = """Copyright (c) 2020, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_ENDORSE = """
3. Neither the name of {} nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
BSD_2 = BSD_CONDITIONS + BSD_WARRANTY
BSD_3 = BSD_CONDITIONS + BSD_ENDORSE + BSD_WARRANTY
GNU = """    This {0} is free software{1} you can redistribute it and/or modify
    it under the terms of the GNU {2} Public License as published by
    the Free Software Foundation{3} either version {4} of the License, or
    (at your option) any later version.

    This {0} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""

SAMPLES = [
    ("BSD-2-Clause", BSD_2),
    ("BSD-3-Clause", BSD_3.format("the copyright holder")),
    ("BSD-3-Clause", BSD_3.format("the University")),
    ("BSD-3-Clause", BSD_3.format("Some Company Inc.")),
    ("BSD-3-Clause,BSD-2-Clause", BSD_3.format("the Project") + "\n----\n\n" + BSD_2),
    (
        "ISC",
        """ISC License

Copyright (c) 2020 Someone

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""",
    ),
    (
        "0BSD",
        """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS".
""",
    ),
    ("GPL-2.0-or-later", GNU.format("program", ";", "General", ";", "2")),
    ("GPL-3.0-or-later", GNU.format("program", ":", "General", ",", "3")),
    ("LGPL-2.1-or-later", GNU.format("library", ";", "Lesser General", ";", "2.1")),
    ("LGPL-3.0-or-later", GNU.format("program", ":", "Lesser General", ",", "3")),
    ("AGPL-3.0-or-later", GNU.format("program", ":", "Affero General", ",", "3")),
    (
        "GPL-2.0-only",
        """ * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License version 2 as
 * published by the Free Software Foundation.
""",
    ),
    ("GPL-2.0-only", "        GNU GENERAL PUBLIC LICENSE\n           Version 2, June 1991\n\n Copyright (C) 1989, 1991\n"),
    ("LGPL-3.0-only", "     GNU LESSER GENERAL PUBLIC LICENSE\n        Version 3, 29 June 2007\n\n Copyright (C) 2007\n"),
    ("AGPL-3.0-only", "     GNU AFFERO GENERAL PUBLIC LICENSE\n        Version 3, 19 November 2007\n\n Copyright (C) 2007\n"),
    (
        "MPL-2.0",
        """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
""",
    ),
    ("Apache-2.0", "                Apache License\n          Version 2.0, January 2004\n       http://www.apache.org/licenses/\n"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy.\n"),
    (
        "Zlib",
        """Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

3. This notice may not be removed or altered from any source distribution.
""",
    ),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted\n"),
    ("EPL-2.0", "Eclipse Public License - v 2.0\n\nTHE ACCOMPANYING PROGRAM IS PROVIDED\n"),
    ("CC0-1.0", "Creative Commons Legal Code\n\nCC0 1.0 Universal\n\n    CREATIVE COMMONS\n"),
    ("CC-BY-SA-4.0", "Attribution-ShareAlike 4.0 International\n\n=====\n\nCreative Commons Corporation\n"),
    ("CC-BY-SA-4.0", "Text. This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. End."),
    ("MIT", "This code is released under the MIT License."),
    ("MIT", "See below.\nThis project is licensed under the terms of the MIT license, see LICENSE.\nLicensed under the MIT license\n"),
    ("GPL-3.0-or-later", "// SPDX-License-Identifier: GPL-3.0-or-later\n#include <x>\n"),
    ("BSD-2-Clause", "/* SPDX-License-Identifier: BSD-2-Clause */\n"),
    ("MIT,Apache-2.0", "// SPDX-License-Identifier: MIT OR Apache-2.0\nint x;\n"),
    ("", "Neither the name of the University nor the names of its students were on the list."),
]
