"""Licence notices and short licences that are looked for. Fixed values."""

MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    'rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit '
    'persons to whom the Software is furnished to do so, subject to the following conditions: '
)
MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    'WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR '
    'COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, '
    'ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
)
BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: "
)
BSD_ONE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
BSD_TWO = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution. "
)
BSD_THREE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. "
)
BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
)
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
    "that the above copyright notice and this permission notice appear in all copies. "
)
ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS."
)

BSD_ADVERTISING = "All advertising materials mentioning features or use of this software must display the following acknowledgement: "
BSD_SOFTWARE_BY = "This product includes software developed by the organization. "

# Rules, the more specific first: (licence, text whose sentences must follow each other).
RULES = [
    ("MIT", MIT_GRANT + MIT_NOTICE + MIT_WARRANTY),
    ("BSD-4-Clause", BSD_GRANT + BSD_ONE + BSD_TWO + BSD_ADVERTISING + BSD_SOFTWARE_BY + BSD_THREE + BSD_WARRANTY),
    ("BSD-3-Clause", BSD_GRANT + BSD_ONE + BSD_TWO + BSD_THREE + BSD_WARRANTY),
    ("BSD-2-Clause", BSD_GRANT + BSD_ONE + BSD_TWO + BSD_WARRANTY),
    ("ISC", ISC_GRANT + ISC_WARRANTY),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. " + ISC_WARRANTY),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
     "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
     "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
     "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
     "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
     "with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
     "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, "
     "and by any means."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]

# Other wordings of a sentence above; SLOT stands for 1 to 24 words, as a holder's name.
SLOT = "<holder>"
VARIANTS = [
    (BSD_THREE, [
        f"{start} of {SLOT} may be used to endorse or promote products derived from this {thing} without{specific} prior written permission."
        for start in ("Neither the name", "Neither the names") for thing in ("software", "material") for specific in ("", " specific")
    ] + [
        f"The {names} of {SLOT} may not be used to endorse or promote products derived from this software without{specific} prior written permission."
        for names in ("name", "names") for specific in ("", " specific")
    ] + [f"Neither {SLOT} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."]),
    (BSD_SOFTWARE_BY, [f"This product includes software developed by {SLOT}."]),
    (BSD_WARRANTY, [BSD_WARRANTY.replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", SLOT)]),
    (MIT_NOTICE, [MIT_NOTICE.replace("notice shall", "notice (including the next paragraph) shall")]),
    (MIT_WARRANTY.split(". ")[1], [MIT_WARRANTY.split(". ")[1].replace("THE AUTHORS OR COPYRIGHT HOLDERS", SLOT)]),
    (ISC_GRANT, [ISC_GRANT.replace("and/or distribute", "and distribute")]),
    (ISC_WARRANTY, [ISC_WARRANTY.replace("THE AUTHOR", SLOT)]),
]

# Titles and opening sentences of full texts.
OPENINGS = [
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
] + [
    (f"CC-BY{short}-4.0", "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and conditions of this "
     f'Creative Commons Attribution{long} 4.0 International Public License ("Public License").')
    for short, long in (("", ""), ("-SA", "-ShareAlike"), ("-NC", "-NonCommercial"), ("-ND", "-NoDerivatives"),
                        ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", "-NonCommercial-NoDerivatives"))
]

# Names in notices of any wording ("this file is licensed under the ..."), as patterns over lower-case words.
_GNU = {"GPL": r"(?:gnu )?(?:gpl|general public licen[sc]e)(?: gpl)?", "LGPL": r"(?:gnu )?(?:lgpl|lesser general public licen[sc]e)(?: lgpl)?",
        "AGPL": r"(?:gnu )?(?:agpl|affero general public licen[sc]e)(?: agpl)?"}
_LATER = r"(?: licen[sc]e)?(?: or (?:at your option )?(?:any )?(?:later|newer)(?: version)?)"
NAMES = [
    (f"{kind}-{number}{end}", rf"{pattern}(?: version| v)? ?v?{digits}{later}")
    for kind, pattern in _GNU.items()
    for number, digits in (("2.0", r"2(?: 0)?(?! \d)"), ("2.1", "2 1"), ("3.0", r"3(?: 0)?(?! \d)")) if (kind, number) not in (("GPL", "2.1"), ("AGPL", "2.0"), ("AGPL", "2.1"))
    for end, later in (("-or-later", _LATER), ("", r"(?: only)?"))
] + [
    ("MIT", "(?:mit|expat)"), ("Apache-2.0", r"apache(?: software)?(?: licen[sc]e)?(?: version| v)? ?v?2(?: 0)?(?! \d)(?: the licen[sc]e)?"),
    ("BSD-2-Clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|two clause bsd)"), ("BSD-3-Clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|three clause bsd)"),
    ("ISC", "isc"), ("MPL-2.0", r"(?:mozilla public licen[sc]e|mpl)(?: version| v)? ?v?2(?: 0)?(?! \d)"), ("Unlicense", "unlicen[sc]e"),
    ("CC0-1.0", "(?:cc0(?: 1 0)?(?: universal)?|creative commons zero(?: 1 0)?)"),
] + [
    (f"CC-BY{short}-4.0", rf"(?:cc by{code}|creative commons attribution{name})(?: international)? 4 0(?: international)?(?: public)?")
    for short, code, name in (("", "", ""), ("-SA", " sa", " share ?alike"), ("-NC", " nc", " non ?commercial"), ("-ND", " nd", " no ?deriv(?:ative)?s"),
                              ("-NC-SA", " nc sa", " non ?commercial share ?alike"), ("-NC-ND", " nc nd", " non ?commercial no ?deriv(?:ative)?s"))
]
